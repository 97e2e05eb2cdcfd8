"""Where the driver's tables are."""

import os
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))
