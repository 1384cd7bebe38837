"""The stages of the pipeline each do their own work, and the catalog carries them."""

import __spark_entry__
import corpus_pipeline
from foliant.llm.common import staged, word_list


def test_stages_keep_columns_and_decide(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = staged(stage(spark, docs, sf_dir))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        sizes.append(after.count())
        if k == 1:
            assert after.select("text").distinct().count() == after.count()
        docs = after
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0 and docs.select("sequence_id").distinct().count() > 0


def test_catalog_has_all_eleven():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_near_stage_equals_brute_force_on_five_words(spark, sf_dir):
    base = [f"w{i}" for i in range(100)]
    some = [base, base[:50] + ["x"] + base[51:], [w if i % 20 else "y" for i, w in enumerate(base)], ["a", "b", "c"], ["A", "b", "c"], ["a", "b", "d"], []]
    made = spark.createDataFrame([(10**9 + i, " ".join(w)) for i, w in enumerate(some)], "doc_id long, text string")
    # The second text stays near the first; the third shares 83 % of its pairs of words but no 80 % of its fives.
    docs = staged(corpus_pipeline.drop_exact_copies(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).select("doc_id", "text").unionByName(made))
    words = {r["doc_id"]: word_list(r["text"]) for r in docs.collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    wanted = {i for i in ids if find(i) == i}
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()} == wanted
    assert {10**9, 10**9 + 2, 10**9 + 3, 10**9 + 5, 10**9 + 6} <= wanted and not {10**9 + 1, 10**9 + 4} & wanted
