"""``python -m podium <step> ...``, or this file under ``spark-submit``."""

from podium.cli import main

if __name__ == "__main__":
    main()
