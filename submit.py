"""spark-submit launcher: ``spark-submit --py-files cdrflow.zip submit.py batch|stream ...``."""

from cdrflow.__main__ import main

if __name__ == "__main__":
    main()
