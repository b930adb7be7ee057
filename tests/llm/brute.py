"""Plain versions of the operators' contracts, for comparison on small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hexed(data: str | bytes, kind: str = "sha256") -> str:
    return hashlib.new(kind, data.encode() if isinstance(data, str) else data).hexdigest()


def bpe(docs, path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    out = set()
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        out.add((doc, len(ids), hexed(" ".join(map(str, ids))), hexed(decoded)))
    return out


def contamination(docs, items, size=10):
    windows = {}
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        length = min(size, len(words))
        for i in range(len(words) - length + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + length]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = set()
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for length in lengths:
            for i in range(len(words) - length + 1):
                if items_here := windows.get(tuple(words[i : i + length])):
                    hit.update(range(i, i + length))
                    found |= items_here
        named = ",".join(sorted(map(str, found)))
        out.add((doc, len(words), len(hit), len(found), hexed(named), bool(hit)))
    return out


def archived(pages, least=1000):
    responses = {}
    for page, content in pages:
        data = (content or "").encode()
        responses[data] = max(page, responses.get(data, page))
    out = set()
    for page, content in pages:
        data = (content or "").encode()
        revisits = len(data) >= least and responses[data] != page
        kind = "revisit" if revisits else "response"
        out.add((page, len(data), hexed(data, "sha1"), kind, responses[data] if revisits else None))
    return out


def base_rules(docs):
    out = set()
    for doc, text in docs:
        text = text or ""
        words = SPACED.findall(text)
        lines = [line for line in text.split("\n") if SPACED.search(line)]
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(triples)
        again = {i + k for i, t in enumerate(triples) if times[t] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.add((doc, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed))
    return out


def without_repeats(docs, depth=50):
    """docs are (key, text); rows of one key don't remove from each other."""
    data = [(doc, (text or "").encode()) for doc, text in docs]
    least = {}
    for doc, body in data:
        for i in range(len(body) - depth + 1):
            window = body[i : i + depth]
            least[window] = min(doc, least.get(window, doc))
    out = []
    for doc, body in data:
        gone = bytearray(len(body))
        for i in range(len(body) - depth + 1):
            if least[body[i : i + depth]] < doc:
                gone[i : i + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        out.append((doc, len(body), sum(gone), len(re.findall(rb"\x01+", gone)), hexed(kept)))
    return out


def near_groups(docs, size=5, percent=75):
    sets = {}
    for doc, text in docs:
        words = SPACED.findall((text or "").translate(LOWER))
        count = max(1, len(words) - size + 1) if words else 0
        sets[doc] = {tuple(words[i : i + size]) for i in range(count)}
    root = {doc: doc for doc in sets}

    def top(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    keys = sorted(d for d in sets if sets[d])
    for at, a in enumerate(keys):
        for b in keys[at + 1 :]:
            if 100 * min(len(sets[a]), len(sets[b])) < percent * max(len(sets[a]), len(sets[b])):
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {(doc, len(sets[doc]), top(doc), top(doc) == doc) for doc in sets}


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def url_rule(host, path, rules):
    fitting = [
        (len(h + p), h + p, kind)
        for kind, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fitting)[1:] if fitting else (None, None)


def base_scores(docs):
    """By key: fold, tokens, known tokens, training tokens, base score."""
    tokens = {doc: [*SPACED.findall((text or "").translate(LOWER)), None] for doc, text in docs}
    held_out = {doc: zlib.crc32(str(doc).encode()) % 7 == 2 for doc in tokens}
    counts = Counter(t for doc, found in tokens.items() if not held_out[doc] for t in found)
    total, distinct = sum(counts.values()), len(counts)
    return {
        doc: (
            held_out[doc], len(found), sum(counts[t] > 0 for t in found), total,
            sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in found),
        )
        for doc, found in tokens.items()
    }


def pieces(docs, path):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    out = set()
    for doc, text in docs:
        ids = processor.encode(text or "")
        out.add((doc, len(ids), hexed(",".join(map(str, ids))), hexed(processor.decode(ids))))
    return out


def _chained(*parts):
    return hexed("".join(parts))


def _levels(nodes, run):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([_chained(*found[-1][i : i + run]) for i in range(0, len(found[-1]), run)])
    return found


def _siblings(levels, place, run):
    out = []
    for nodes in levels[:-1]:
        first = place // run * run
        out.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + run])))
        place //= run
    return out


def manifest(rows, run=16):
    """Rows are (doc_id, source, lang, n_chars, text); one row of the result for each."""

    def leaf(row, text):
        return _chained(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])

    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[4]), row))
    order = sorted(trees, key=lambda source: (source is not None, (source or "").encode()))
    below = []
    for source in order:
        trees[source].sort(key=lambda found: found[:3])
        below.append(_levels([found[2] for found in trees[source]], run))
    above = _levels([levels[-1][0] for levels in below], run)
    out = []
    for k, source in enumerate(order):
        for i, (has_key, key, own, row) in enumerate(trees[source]):
            path, node = _siblings(below[k], i, run) + _siblings(above, k, run), own
            if has_key and zlib.crc32(str(key).encode()) % 5 == 0 and row[4] is not None:
                node = leaf(row, row[4].translate(LOWER))
            for left, right in path:
                node = _chained(left, node, right)
            root = above[-1][0]
            proof = _chained(*[left + right for left, right in path])
            out.append((row[0], own, below[k][-1][0], root, proof, node, node == root))
    return out


def whitening(rows, most=8):
    """Rows are (key, vector); keys, exact deviations, whitened values and explained shares."""
    import numpy as np

    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    covariance = np.array([[value / n**3 for value in row] for row in away.T @ away], dtype=float)
    variances, axes = np.linalg.eigh(covariance)
    variances, axes = variances[::-1], axes[:, ::-1]
    whitened = (away / n).astype(float) @ axes[:, :most] / np.sqrt(variances[:most])
    return [k for k, _ in kept], (away**2).sum(axis=1).tolist(), whitened, variances[:most] / np.trace(covariance)
