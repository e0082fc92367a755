"""Language identification: the tables by counting, scores by a plain reading of the method, held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import pytest

from millwright.llm import langid

SCHEMA = "doc_id long, text string, lang string, source string, score string, row string"
EN = "the cat sat on the mat while a dog ran over the hill and away from the river with all of its friends"
DE = "der hund lief über den hügel und die katze saß auf der matte während alle freunde am fluss waren"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(120):
        lang, words = rng.choice([("en", EN.split()), ("de", DE.split())])
        text = " ".join(rng.choice(words) + rng.choice(["", "", "s", "en"]) for _ in range(rng.randint(3, 40)))
        out.append((i, text.capitalize() + ".", lang))
    return out + [(200, None, "en"), (201, "", "de"), (202, "12 -- 7!", "en"), (203, "привет мир", None), (204, "the dog", None), (None, "der hund", "en"), (0, out[0][1], out[0][2]), (205, "x" * 300 + " the", "en")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", "x", "y") for i, t, g in rows], SCHEMA).repartition(3)


def by_hand(rows):
    """(languages, tables): tables[length][lang][unit] with length 0 for words; nothing is cut off."""
    learned = [(t, g) for i, t, g in rows if i is not None and t is not None and g is not None and crc(i) != 2]
    languages = [g for g, _ in sorted(Counter(g for _, g in learned).items(), key=lambda p: (-p[1], p[0]))]
    words = {g: Counter() for g in languages}
    for text, lang in set(learned):
        words[lang].update("".join(c if c.isalpha() else " " for c in text.lower()).split())
    tables = []
    for length in range(langid.ORDER + 1):
        table = {}
        for lang in languages:
            counts = Counter()
            for word, n in words[lang].items():
                padded = word if length < 2 else f" {word} "
                for unit in [word] if not length else [padded[i:i + length] for i in range(len(padded) - length + 1)]:
                    counts[unit] += n
            total = sum(counts.values())
            table[lang] = {u: max(math.log(n / total), langid.PENALTY) for u, n in counts.items()}
        tables.append(table)
    return languages, tables


def score(text, languages, tables):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    sums = dict.fromkeys(languages, 0.0)
    for word in words:
        for length in [0, *range(langid.ORDER, 0, -1)]:
            padded = word if length < 2 else f" {word} "
            units = [word] if not length else [padded[i:i + length] for i in range(len(padded) - length + 1)]
            units = [u for u in units if any(u in tables[length][g] for g in languages)]
            if units:
                break
        for lang in languages:
            sums[lang] += sum(tables[length][lang].get(u, langid.PENALTY) for u in units) / len(units) if units else langid.PENALTY
    if not words:
        return "und", 0.0
    best = max(languages, key=lambda g: sums[g])
    return best, 1 / sum(math.exp(sums[g] - sums[best]) for g in languages)


def test_equals_the_plain_method(spark, rows):
    docs = frame(spark, rows)
    found = langid.predicted(docs, langid.fit(docs)).select("doc_id", "row.text", "lang_pred", "score").collect()
    languages, tables = by_hand(rows)
    assert len(found) == len(rows)
    for r in found:
        lang, value = score(r["text"], languages, tables)
        assert (r["lang_pred"], r["score"]) == (lang, pytest.approx(value, abs=1e-4)), r["text"]


def test_model_holds_the_most_frequent(spark, rows, monkeypatch):
    monkeypatch.setattr(langid, "ENTRIES", 5)
    model = langid.fit(frame(spark, rows))
    languages, tables = by_hand(rows)
    assert model.languages == languages
    for length in range(langid.ORDER + 1):
        top = {u for g in languages for u in sorted(tables[length][g], key=lambda u: (-tables[length][g][u], u))[:5]}
        assert set(model.words if not length else model.grams[length - 1]) == top


def test_labels_of_held_out_rows_are_never_learned(spark, rows):
    swapped = [(i, t, "xx" if i is not None and crc(i) == 2 else g) for i, t, g in rows]
    assert "xx" not in langid.fit(frame(spark, swapped)).languages


def test_sample_is_bounded_and_counts_copies_once(spark, rows):
    copies = rows + [(1000 + i, "der der der", "de") for i in range(50)]
    languages, words = langid.sample_words(frame(spark, copies), 10_000)
    counts = {(r["lang"], r["word"]): r["n"] for r in words.collect()}
    alone = Counter(w for t in {t for i, t, g in copies if i is not None and t and g == "de" and crc(i) != 2} for part in langid.words_of(t) for w in part)
    assert counts[("de", "der")] == alone["der"]
    _, few = langid.sample_words(frame(spark, rows), 1)
    assert sum(r["n"] for r in few.collect()) <= 2 * 45


def test_no_letters_no_model_and_ties(spark):
    docs = frame(spark, [(1, "abc", None), (2, None, None)])
    assert {(r["lang_pred"], r["score"]) for r in langid.predicted(docs, langid.fit(docs)).collect()} == {("und", 0.0)}
    empty = frame(spark, [])
    assert langid.predicted(empty, langid.fit(empty)).count() == 0
    learned = [i for i in range(50) if crc(i) != 2]
    docs = frame(spark, [(learned[0], "aaa", "b"), (learned[1], "aaa", "a"), (learned[2], "東京", None), (learned[3], "١٢", None)])
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predicted(docs, langid.fit(docs)).collect()}
    assert found[learned[0]] == ("a", 0.5) and found[learned[2]] == ("a", 0.5) and found[learned[3]] == ("und", 0.0)


def test_memory_of_words_does_not_change_scores(spark, rows, monkeypatch):
    docs = frame(spark, rows)
    model = langid.fit(docs)
    texts = [t for _, t, _ in rows if t] + ["unheard words come again and again " * 9]
    whole = [model.scorer().predict(t) for t in texts]
    monkeypatch.setattr(langid, "REMEMBERED", 4)
    monkeypatch.setattr(langid, "PIECE", 3)
    scorer = model.scorer()
    assert [scorer.predict(t) for t in texts] == [(lang, pytest.approx(value, abs=1e-6)) for lang, value in whole]


def test_held_out_accuracy(spark, small):
    from millwright.llm.common import table
    docs = table(spark, small, "documents")
    found = langid.predicted(docs, langid.fit(docs))
    judged = [(r["row"]["lang"], r["lang_pred"]) for r in found.collect() if r["row"]["lang"] and crc(r["doc_id"]) == 2]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged) > 0
