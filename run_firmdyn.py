"""Launcher for spark-submit: the command line of ``firmdyn`` from any folder.

    spark-submit --py-files firmdyn.zip run_firmdyn.py PANEL_DIR OUT_DIR [options]
"""

import sys

from firmdyn.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
