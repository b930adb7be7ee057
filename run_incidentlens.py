"""Script for ``spark-submit``; same arguments as ``python -m incidentlens``."""

from incidentlens.__main__ import main

if __name__ == "__main__":
    main()
