"""Entry for ``spark-submit run.py <step> ...``; see ``medallion.__main__``."""

from medallion.__main__ import main

if __name__ == "__main__":
    main()
