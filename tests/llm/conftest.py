"""Documents with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, core long, hull long, spans string, _id long, score double, digest string"


def make_rows():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice(["th", "an", "er", "on", "re", "é", "st", "ü"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, other = words(130), words(60)
    base = words(200)
    texts = [words(rng.randint(1, 150)) for _ in range(12)]
    texts += [base, base, base + " ", base.replace(" ", "\n", 3), base.replace(base.split()[50], "changed", 1)]
    texts += [f"{words(30)} {passage} {words(20)}", f"{passage}\n{words(9)}", f"{words(3)} {passage[7:]}", f"{other} {words(5)} {other}", f"{other[3:]} x"]
    texts += ["", None, "   \n\t ", "a", "word " * 300, "é" * 500, words(9000), "GNU General Public License v3, MIT license; cc-by", "Released under the MIT License."]
    rows = [(i, t, "en", "src0" if i % 3 else None, None if t is None else len(t), "k", 1, 2, "s", i, 0.5, "d") for i, t in enumerate(texts)]
    rows.append(rows[3])  # a row repeated as a whole
    rows.append((None, "null id " + words(40), None, "src1", None, None, None, None, None, None, None, None))
    rows.append((None, base, None, None, None, None, None, None, None, None, None, None))
    rows.append((5, "another text with the same id " + words(30), "en", "src2", 3, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
