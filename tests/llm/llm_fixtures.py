"""Small documents for the corpus operators, made by rule from a seed."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use inside; "w" and "H" differ from theirs by case only.
CLASHING = ("t", "W", "ls", "pos", "H", "h2", "runs", "leaf", "home", "score", "id", "th", "_text", "kept", "labels", "slot")


def words(rng, n):
    return [rng.choice(["ba", "ko", "mi", "ter", "lun", "sa"]) + rng.choice(["do", "re", "va", "né", "zu"]) for _ in range(n)]


def line(rng, n):
    return " ".join(words(rng, n)).capitalize() + "."


def corpus(seed=5):
    """(doc_id, text) with copies, near copies, shared passages, junk and odd texts."""
    rng = random.Random(seed)
    base = ["\n".join(line(rng, rng.randint(4, 40)) for _ in range(rng.randint(2, 9))) for _ in range(24)]
    passage = line(rng, 60)
    block = "\n".join(line(rng, 22) for _ in range(4))
    texts = list(base)
    texts += [base[0], base[0], base[3]]  # exact copies
    near = base[1].split(" ")
    near[7] = "changed"
    texts += [" ".join(near), base[1] + " tail."]
    texts += [base[k] + "\n" + passage + "\n" + base[k + 1] for k in (4, 6, 8)]
    texts += [base[k] + "\n" + block + "\n" + base[k + 2] for k in (9, 11)]
    texts += [block + "\n\n" + block, "ü, " * 700, "la " * 400, "A" * 1500, "x" * 399, "y" * 400]
    texts += ["home | about | news | shop\n" * 30, "word!! " * 80, "a%%% b$$$ c### " * 40]
    texts += ["", None, " \t\n ", "one", "two words", "ÀÉ Kelvin K\x0bv \x1c z", line(rng, 6000)]
    # Words apart by tabs, and indentation: a line weighs its words.
    tabbed = "\t".join(words(rng, 60))
    texts += [base[13] + "\n" + tabbed, tabbed + "\n" + base[14], "        }\n    }\n}\n" * 30, "        }\n    }\n}\n" * 20 + base[15]]
    return [(k, t) for k, t in enumerate(texts)]


def frame(spark, rows, clash=True):
    """documents with the given (doc_id, text), and columns of clashing names."""
    df = spark.createDataFrame([(k, t, "xx", "s0", len(t) if t is not None else None) for k, t in rows], SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(7) for c in CLASHING})
    return df


def odd(spark):
    """Null ids, repeated rows, null and empty texts."""
    rows = [(None, "some text of a document"), (None, None), (3, "twice the same row"), (3, "twice the same row"), (4, ""), (5, None)]
    return frame(spark, rows)
