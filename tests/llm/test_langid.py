from ledgerhound.llm import langid as op
from pyspark.sql import functions as F

from .cases import corpus, frame


def slow_phrases(seq, sample):
    """Greedy parse of a list of classes into the longest phrases that occur in the sample."""
    joined = "".join(chr(c + 1000) for c in sample)
    text, at, n = "".join(chr(c + 1000) for c in map(int, seq)), 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in joined:
            size += 1
        at += size
        n += 1
    return n


def test_phrases_against_substring_search():
    samples = {"en": ["the thing and the other thing is here", "a"], "fr": ["la chose et les autres choses ici"]}
    model = op.fit(samples)
    texts = ["the other choses zzz here", "la thing", "", "ththththe chose the chose", "x" * 50]
    seqs = [op.letters(t, model.classes) for t in texts]
    got = op.phrases(seqs, model, segment=10_000)
    for k, lang in enumerate(model.langs):
        sample = [c for t in samples[lang] for c in (*op.letters(t, model.classes).tolist(), 500)]
        sample = [c if c != op.STRANGE else 600 for c in sample]
        assert got[:, k].tolist() == [slow_phrases(s, sample) for s in seqs]
    # Segments add at most one phrase each, whatever the language.
    cut = op.phrases(seqs, model, segment=8)
    assert ((cut - got) <= [[-(-len(s) // 8)] * 2 for s in seqs]).all() and (cut >= got).all()


def test_held_out_accuracy_and_defined_cases(spark):
    rows = corpus(n=120)
    docs = frame(spark, rows).withColumn("h", F.coalesce(op.fold(F.col("doc_id")) == 0, F.lit(False)))
    model = op.fit(op.labelled_sample(docs, "lang", ~F.col("h")))
    got = op.predict(docs, model, "doc_id", "h", "lang", "text").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr") and 0 <= r.score <= 1
    held = [r for r in got if r.h and r.lang_pred != "und"]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_nothing_labelled_and_empty_table(spark):
    docs = frame(spark, [(1, "some words", None)])
    model = op.fit(op.labelled_sample(docs, "lang", F.lit(True)))
    assert model is None and [r.lang_pred for r in op.predict(docs, model, "doc_id").collect()] == ["und"]
    assert op.predict(docs.limit(0), op.fit({"en": ["abc"]}), "doc_id").collect() == []


def test_copies_take_one_place_of_the_sample(spark):
    en = [(1000 * k + n, f"english words number {chr(97 + k % 26)}{chr(97 + k // 26)}", "en") for k in range(70) for n in range(66)]
    same = "le meme debut " * 40  # texts that differ only behind their excerpt
    fr = [(10 ** 6 + n, f"{same}{n}", "fr") for n in range(200)] + [(2 * 10 ** 6 + n, f"autre texte {chr(97 + n)}", "fr") for n in range(20)]
    got = op.labelled_sample(frame(spark, en + fr), "lang", F.lit(True))
    assert len(got["en"]) == len(set(got["en"])) == op.SAMPLE_TEXTS
    assert sorted(got["fr"]) == sorted({t[:op.EXCERPT_CHARS] for _, t, _ in fr})


def test_every_letter_of_the_samples_counts(monkeypatch):
    rare = {"ko": "".join(chr(0xAC00 + k) for k in range(600)), "zh": "".join(chr(0x4E00 + k) for k in range(600))}
    samples = {x: [t, t[::7] + " " + t[::-1]] for x, t in rare.items()}
    model = op.fit(samples)
    assert op.decide([op.letters(rare["zh"][a:a + 5], model.classes) for a in (0, 300, 590)], model)[0][0] == "zh"
    assert {x for x, _ in op.decide([op.letters(rare["zh"][a:a + 5], model.classes) for a in range(0, 595, 5)], model)} == {"zh"}
    assert {x for x, _ in op.decide([op.letters(rare["ko"][a:a + 5], model.classes) for a in range(0, 595, 5)], model)} == {"ko"}
    texts = [rare["zh"][:40] + rare["ko"][100:90:-1] + " " + rare["zh"][3:80:7] + "\u3042xyz", rare["ko"][::5], "\u3042" * 4, ""]
    seqs = [op.letters(t, model.classes) for t in texts]
    got = op.phrases(seqs, model, segment=10_000)
    for k, lang in enumerate(model.langs):
        sample = [c for t in samples[lang] for c in (*op.letters(t, model.classes).tolist(), 5000)]
        assert got[:, k].tolist() == [slow_phrases(s, sample) for s in seqs]
    # However few letters have a column, the parse is the same.
    whole = op.fit({"en": ["the thing and the other thing"], "fr": ["la chose et les autres choses"]})
    monkeypatch.setattr(op, "ALPHABET", 3)
    few = op.fit({"en": ["the thing and the other thing"], "fr": ["la chose et les autres choses"]})
    both = [op.phrases([op.letters(t, m.classes) for t in ("the other choses", "zq thing", "autre")], m).tolist() for m in (whole, few)]
    assert both[0] == both[1]
