import sys
from pathlib import Path

import pytest

from incidentlens.llm.queries import vocabulary_path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import prose  # noqa: E402

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def vocabulary():
    return vocabulary_path()


@pytest.fixture(scope="session")
def awkward():
    """(key, text): nulls, empty, very long and repeated texts, many copies, odd characters."""
    base, passage = prose(1, 120), prose(2, 30)
    words = base.split()
    near = [" ".join([*words[:k], prose(900 + k, 1), *words[k + 1 :]]) for k in range(0, 120, 4)]
    apart = [" ".join(w if (i + k) % 5 else prose(5000 + 97 * k + i, 1) for i, w in enumerate(words)) for k in range(10)]
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "one two three four", "One two THREE four",
        base, base, base.upper(), base + " " + passage, prose(3, 80) + "\n" + passage + "\n" + prose(4, 90),
        "\n".join([prose(5, 6)] * 40), "café naïve 你好 \U0001f600 " * 12, "é" * 60, "x" * 200,
        "nul\x00here     end #*$%&|<>", prose(6, 20_000), prose(6, 20_000) + " tail",
        *near, *apart, *[prose(7, 60)] * 50,
    ]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def awkward_docs(spark, awkward):
    """The rows with columns whose names operators use themselves."""
    clashing = "doc_id long, text string, block long, words string, digest string, bucket int, shard int, doc long, g int"
    rows = [(k, t, 1, "w", "d", 2, 3, 4, None) for k, t in awkward]
    return spark.createDataFrame(rows, clashing)


@pytest.fixture(scope="session")
def given(spark, small):
    """(key, text) of the given documents."""
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
