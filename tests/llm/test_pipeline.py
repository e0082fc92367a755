"""The pipeline against its stages done by brute force, and on tables with nothing in them."""

import random

import pytest

import corpus_pipeline
from millwright.llm import decontamination, line_crf
from tests.llm.test_documents import brute_components, brute_lines, brute_matches, brute_print, tokenized

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    words = [f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(300)]

    def prose(lines):
        return "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(8, 20))).capitalize() + "." for _ in range(lines))

    items = [(n, " ".join(rng.choice(words) for _ in range(20))) for n in range(4)]
    texts, labels = [], []
    for n in range(150):
        if n % 5 == 0:
            texts.append("\n".join(" ".join(rng.choice(words) + rng.choice(["###", "$$$"]) for _ in range(12)) for _ in range(3)))
        elif n % 11 == 0:
            texts.append(prose(2) + "\n" + items[n % 4][1] + ".\n" + prose(2))
        elif n % 7 == 0 and n > 20:
            texts.append(texts[n - 6])
        else:
            texts.append(prose(rng.randint(2, 6)) + ("\nThis closing line is found in many of the documents." if n % 3 == 0 else ""))
        labels.append((n, 0 if n % 5 == 0 else 1, 0))
    texts += [None, ""]
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(n, t, "en", "s", len(t or "")) for n, t in enumerate(texts)]
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, items


def test_pipeline_equals_brute_force(spark, corpus):
    folder, texts, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = line_crf.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    left = {n: t for n, t in enumerate(texts) if model.score([t or ""])[0] >= line_crf.THRESHOLD}
    assert all(n not in left for n in range(0, 150, 5)) and len(left) > 100
    left = {n: v[2] for n, v in brute_lines(list(left.items())).items()}
    names = list(left)
    roots = brute_components([brute_print(left[n]) for n in names])
    left = {n: left[n] for i, n in enumerate(names) if roots[i] == i}
    leaks = {d for d, _ in brute_matches(list(left.items()), items)}
    assert leaks and len(left) < len(names)
    left = {n: t for n, t in left.items() if n not in leaks}
    ids = dict(zip(left, tokenized(left.values())))
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: r["length"] for r in got} == {n: len(i) for n, i in ids.items()}  # none is longer than a sequence here


def test_stages(spark, corpus):
    folder, _, _ = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs.limit(0), docs.limit(20)):
            assert stage(spark, frame, folder).columns == docs.columns
    assert all(stage(spark, docs.limit(0), folder).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_every_planted_passage_is_found(spark, corpus):
    folder, texts, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = decontamination.matches(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= {(n, i) for n, t in enumerate(texts) for i, body in items if t and body in t}


def test_stages_carry_extra_and_clashing_columns_and_take_repeated_rows(spark, corpus):
    folder, texts, _ = corpus
    rows = [(n, t, "en", "s", len(t or ""), f"r{n}", n, None, "x") for n, t in enumerate(texts[:40])]
    rows += rows[:10] + [(rows[0][0], "another text under the id of the first one, which is long enough to be a line", "en", "s", 3, "o", 1, 2, "y"), (None, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, COLUMNS + ", row string, number long, text_hash long, doc string").repartition(3)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == names, name
        left = [r.asDict() for r in docs.collect()]
        assert left and all(r["row"] is None or r["row"] == "o" or r["row"] == f"r{r['number']}" for r in left), name
        docs = spark.createDataFrame([tuple(r[c] for c in names) for r in left], docs.schema)

    placed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert placed.count() == len(left)
