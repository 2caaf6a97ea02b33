"""Launcher for ``spark-submit launch.py <command> …`` (see ``tarmac/cli.py``)."""

from tarmac.cli import main

if __name__ == "__main__":
    main()
