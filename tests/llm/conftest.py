import random
import re

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Columns named like those the operators add or use inside must do no harm.
CLASHING = ["kept", "size", "row", "text_key", "place", "removed", "key", "n_lines", "grp", "n"]
LAYOUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHING],
])


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(lower(text or ""))


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, source]) tuples, with clashing columns."""
    def make(rows):
        full = []
        for doc_id, text, *source in rows:
            full.append((
                doc_id, text, "en", source[0] if source else "src0",
                None if text is None else len(text), *["x"] * len(CLASHING),
            ))
        return spark.createDataFrame(full, LAYOUT)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every place, empty, blank, very long, equal and repeated texts."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    prose = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 80))) for _ in range(12)]
    rows = [(i, text, f"src{i % 3}") for i, text in enumerate(prose)]
    rows += [(20, None, "src0"), (21, "", "src0"), (22, " \t\n ", None), (None, prose[0], None),
             (None, None, None), (23, prose[1], "src1"), (1, prose[1], "src1"),
             (1, prose[1], "src1"), (24, "One", "src2"), (25, "x" * 300_000, "src2"),
             (26, " ".join(rng.choices(vocabulary, k=30_000)), "src2"),
             (27, "naïve Ünï 漢字 🙂 <|endoftext|>   end\r\nline", "sourcé")]
    return rows
