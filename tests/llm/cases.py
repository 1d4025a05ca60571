"""Small inputs that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, rank int, kept string"


def words(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


def corpus(seed=3, n=60):
    """(doc_id, text, lang) with exact and near copies, blanks, nulls, an empty text, a long text and repeated rows."""
    rng = random.Random(seed)
    vocab = {"en": [f"the{i}ing" for i in range(40)], "fr": [f"é{i}tion" for i in range(40)]}
    vocab = {k: [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in v] for k, v in vocab.items()}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        rows.append((i, words(rng, rng.randrange(3, 80), vocab[lang]), lang))
    rows.append((n, rows[5][1], rows[5][2]))
    rows.append((n + 1, "  " + rows[5][1].replace(" ", "\n\t") + " ", rows[5][2]))
    rows.append((n + 2, rows[6][1] + " tail", rows[6][2]))
    rows.append((n + 3, None, "en"))
    rows.append((n + 4, "", None))
    rows.append((n + 5, " \n\t ", "fr"))
    rows.append((n + 6, "12 34 -- !", "en"))
    rows.append((n + 7, words(rng, 6000, vocab["en"]), "en"))
    rows.append((n + 7, rows[-1][1], "en"))  # a repeated row
    rows.append((7, rows[8][1], "en"))  # an id that comes twice, with another text
    rows.append((None, rows[9][1], "en"))
    rows.append((None, None, None))
    return rows


def frame(spark, rows, partitions=3):
    full = [(i, t, lang, "s", len(t or ""), 0.5, "x", 1, "no") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def labels(spark, rows, quality=lambda i: int(i % 4 != 0)):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    return spark.createDataFrame([(i, quality(i), 0) for i in ids if i % 2 == 0] + [(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
