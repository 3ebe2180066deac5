"""Layout defaults for the registered queries.

Series are windowed in position chunks of 25,000 rows with halos, so a symbol holding
a third of all rows spreads over many tasks; positions are counted per hour bucket.
Every window of the feature plan holds the rows of its chunk, each about 1 KB: chunks
of a million rows spilled, and a few symbols kept a few tasks busy.
"""

from ..config import Ordering

ORDERING = Ordering(keys=("symbol",), order=("ts", "seq"), chunk_rows=25_000, bucket="1 hour")
KEYS = ("symbol",)
