import re
from collections import Counter

import pytest
from llm_cases import awkward, collected, copies, frame
from pyspark.sql import functions as F

from quadrille.llm import quality

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        j
        for i in range(len(words) - 2)
        if windows[tuple(words[i : i + 3])] > 1
        for j in range(i, i + 3)
    }
    lines = [n for n in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", n)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (
        len(words),
        sum(map(len, words)),
        symbols,
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts(spark):
    rows = awkward() + copies()
    rows += [
        (90, "a b c a b c\nx | y\nx | y\n\n \nx | y"),
        (91, "a a a a"),
        (92, "🙂 é ## a*b <c> &d; $5 %"),
        (93, "p q r s p q r"),
        (94, "one two one two one"),
    ]
    out = quality.judge_quality(frame(spark, rows))
    found = collected(out, "doc_id", *BASE, "base_failed", "kept")
    expected = Counter()
    for i, text in rows:
        counts = brute(text)
        expected[(i, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0])] += 1
    assert Counter(f[:-1] for f in found) == expected
    assert not any(kept for *_, failed, kept in found if failed)


def test_texts_in_other_scripts(spark):
    """Vowel signs are letters, and sentences end with the signs of their script."""
    import random

    def text(letters, signs, end):
        r = random.Random(9)

        def word():
            return "".join(r.choice(letters) + r.choice(signs) for _ in range(r.randint(2, 4)))

        return "\n".join(" ".join(word() for _ in range(12)) + end for _ in range(12))

    rows = [
        (1, text("कखगघचजटडतदनपबमयरलवसह", ["ा", "ि", "ी", "ु", "े", "ो", "्", ""], "।")),
        (2, text("ابتثجحدرسشعفقكلمنهوي", ["َ", "ُ", "ِ", ""], "؟")),
        (3, text("我们他的是在有这中大来上国", [""], "。")),
    ]
    out = quality.judge_quality(frame(spark, rows))
    names = ("doc_id", "vote_letters", "vote_sentence_ends", "n_ended_lines", "kept")
    for _, letters, ends, ended, kept in collected(out, *names):
        assert (letters, ends, ended, kept) == (1, 1, 12, True)


def test_carried_rows(spark):
    docs = frame(spark, awkward())
    out = quality.judge_quality(docs, carry=docs.columns)
    assert Counter(out.select("row.*").collect()) == Counter(docs.collect())


def test_native_plan(spark):
    plan = quality.judge_quality(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    )._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_label_model():
    # votes of rules of known accuracy
    patterns = Counter()
    import random

    r = random.Random(5)
    truth = []
    for _ in range(4000):
        good = r.random() < 0.8
        votes = tuple(
            r.choices((-1, 0, 1), (0.02, 0.1, 0.88) if good else (0.5, 0.1, 0.4))[0]
            for _ in range(9)
        )
        patterns[votes] += 1
        truth.append((votes, good))
    model = quality.fit_label_model(list(patterns.items()), 9)

    def verdict(votes):
        return model.bias + sum(w[v + 1] for w, v in zip(model.weights, votes)) > 0

    right = sum(verdict(v) == good for v, good in truth) / len(truth)
    assert right > 0.97
    every = sum(all(x >= 0 for x in v) == good for v, good in truth) / len(truth)
    assert right > every


def test_label_model_without_texts():
    model = quality.fit_label_model([], 3)
    assert model.bias > 0 and all(w[0] < 0 < w[2] for w in model.weights)


@pytest.mark.parametrize("sf", ["0.01"])
def test_accuracy_on_labels(spark, sf):
    """The rules see no labels, so all labels are held out."""
    folder = f"/root/testdata/sf{sf}"
    judged = quality.judge_quality(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    both = judged.join(labels, "doc_id").where("n_words >= 50")
    right = both.agg(
        F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("double"))),
        F.avg(F.when(F.col("quality") == 0, (~F.col("kept")).cast("double"))),
    ).first()
    assert right[0] > 0.97 and right[1] > 0.9


def test_empty_table(spark):
    assert quality.judge_quality(frame(spark, [])).count() == 0
