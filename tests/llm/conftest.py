from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = os.path.join(os.path.dirname(SMALL), "sf0.01")

LONG = " ".join(f"word{i % 997}" for i in range(60_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (5, "ONE two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (5, "ONE two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"),
    (6, "Released under the MIT License. The mit\nlicense, the GNU General Public License; mit licenses."),
    (None, "a row without an id, and one two three four five six seven eight nine ten eleven twelve"),
    (None, "a row without an id, and one two three four five six seven eight nine ten eleven twelve"),
    (7, "ÀÉÎ éàç 日本語 text 👩‍👩‍👧 ßharp İstanbul"),
    (8, LONG),
    (9, "x" * 100_000),
    (10, "\n".join(["The very same line that many documents hold, again and again."] * 3 + ["own line"])),
    (10, "another text of the same id\nThe very same line that many documents hold, again and again."),
] + [(n, f"head {n}\n  The very same LINE that many documents hold, again and again.\t\ntail {n}") for n in range(11, 18)]
CLASHING = ("key version node _id _key digest bits block unit chunk group label span items words pos token kept score held_out "
            "n_words n_lines n_dropped drop_bits keep_bits before slice x run entry row deal piece start offset template covered _version").split()  # fmt: skip


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward row, in several partitions, and columns named like the operators' own."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    more = {name: F.lit(f"extra {name}") for name in CLASHING}
    return docs.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text"), **more})


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def larger():
    return LARGER
