import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, with types that would break them.
CLASHING = ("task", "nth", "chunk", "key", "words", "n_lines", "n_dropped", "node", "fingerprint", "score", "train", "c0", "ids", "length", "lost_keys", "other_doc", "h", "r")


def odd_rows(seed: int = 1) -> list[tuple]:
    """Null, empty and blank texts, a long one, copies, near copies, repeated rows and lines, null ids."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    line = "A line that is shared by MANY documents, word for word " + text(4)
    base = text(120)
    near = base.split()
    near[60] = "other"
    rows = [(1, None), (2, ""), (3, " \n\t\n "), (4, text(9000) + "\n" + line), (5, base), (6, base), (7, " ".join(near))]
    rows += [(k, text(30) + "\n  " + line.upper() + " \n" + text(20)) for k in range(8, 16)]
    rows += [(16, text(40)), (16, text(40)), (17, base + " " + text(40)), (17, base + " " + text(40)), (None, base), (None, None)]
    rows += [(18, "x"), (19, "Å ß é ñ x y 漢字 😀. A, b.\n\n\nc"), (20, "a" * 400), (21, "a" * 300 + "b" * 200), (-5, line), (22, line[:60] + base[:200])]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", None]), None if t is None else len(t)) for i, t in rows]


@pytest.fixture
def odd(spark):
    """The odd rows over several partitions, with further columns that clash with internal names."""
    df = spark.createDataFrame(odd_rows(), COLUMNS).repartition(5)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture
def pairs():
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
