import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Columns whose names the operators use themselves.
CLASH = "n long, key string, row long, cid long, sigs string, hash string, place int, host string, docs long, count long, label int, e string, shard string, slot string, rule string"


def rows_of_texts():
    """(doc_id, text, source): near and exact copies, shared lines, empty, null and long texts, null and repeated ids."""
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows, shared = [], "  All RIGHTS reserved\t"
    for i in range(40):
        base = prose(r.choice([3, 8, 30, 120]))
        rows.append((len(rows), base + ("\n" + shared if i % 3 == 0 else ""), f"s{i % 4}"))
        if i % 4 == 0:
            w = base.split()
            w[r.randrange(len(w))] = "changed"
            rows.append((len(rows), " ".join(w), "s0"))
            rows.append((len(rows), base.upper().replace("É", "é"), "s1"))
    long = prose(30_000)
    rows += [
        (900, long, "s0"), (901, long + " more", "s0"), (902, None, "s1"), (903, "", None), (904, " \n\t\n ", "s1"),
        (None, rows[0][1], "s1"), (None, "only here", None), (5, rows[5][1], "s1"), (5, rows[5][1], "s1"), (905, "ab " * 400, "s2"),
        (906, "x" * 100_000, "s2"), (907, "\n".join(["same line"] * 50 + ["other $$ <b>"]), "s2"), (908, "a\nb\n\n", "s3"), (909, "İ ß x y \x1c z", "s3"),
    ]
    return rows


@pytest.fixture(scope="session")
def texts():
    return rows_of_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    clash = [None] * len(CLASH.split(","))
    return spark.createDataFrame([(*x, *clash) for x in texts], f"doc_id long, text string, source string, {CLASH}").repartition(5)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
