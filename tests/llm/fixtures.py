"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHES = "_key string, _id long, id long, text_key long, row string, key string, label int, _text string"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SOLID = r"[^\x20\x09-\x0D]+"


def fold(text):
    return re.sub("[A-Z]+", lambda m: m.group(0).lower(), text or "")


def words(text, pattern):
    return re.findall(pattern, fold(text))


def sentence(rng, size):
    return " ".join("".join(rng.choice("abcdefgéñ") for _ in range(rng.randint(2, 7))) for _ in range(size))


def rows(seed=5):
    rng = random.Random(seed)
    base = sentence(rng, 60)
    texts = [None, "", "   \n\t", "One", "one two", base, base, base.upper(), base + " extra", base.replace(" ", "\n")]
    for _ in range(12):  # near copies, each a word or two off
        changed = base.split()
        for _ in range(rng.randint(1, 4)):
            changed[rng.randrange(len(changed))] = sentence(rng, 1)
        texts.append(" ".join(changed))
    texts += [sentence(rng, rng.randint(1, 80)) for _ in range(20)]
    texts.append(sentence(rng, 30_000))
    texts.append("x" * 200_000)
    out = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]
    return out + [out[5], (None, base, None, None, 0), (None, None, None, None, None)]


def documents(spark, extra=()):
    return spark.createDataFrame(rows() + list(extra), SCHEMA)


def clashing(spark):
    """The same rows with further columns under the names that operators use."""
    names = [c.strip().split(" ") for c in CLASHES.split(",")]
    return documents(spark).selectExpr("*", *[f"cast({7 + i} as {t}) as {n}" for i, (n, t) in enumerate(names)])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def kept_clashes(before, after):
    """Whether the extra columns are all there with their values."""
    names = [c.strip().split(" ")[0] for c in CLASHES.split(",")]
    assert [c for c in after.columns if c in before.columns] == before.columns
    for row in after.select(names).distinct().collect():
        assert [int(v) for v in row] == [7 + i for i in range(len(names))]
