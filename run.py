"""spark-submit entry point: spark-submit --py-files meterflow.zip run.py <command> ..."""

from meterflow.__main__ import main

if __name__ == "__main__":
    main()
