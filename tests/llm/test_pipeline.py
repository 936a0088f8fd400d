import random

import corpus_pipeline
from plain import FOLDER, class_of, fingerprint, rows, words

import __spark_entry__


def test_stages_on_planted_cases(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    passage = text(60)
    clean = [(i, text(120)) for i in range(60)]
    docs = list(clean)
    docs += [(100 + i, clean[i][1]) for i in range(5)]  # exact copies
    docs += [(110 + i, clean[i][1].rsplit(" ", 1)[0] + " " + word()) for i in range(5)]  # near copies
    long = text(1500)  # one word of many changed: few bits differ
    clean.append((60, long))
    docs += [(60, long), (150, long + " " + word()), (151, word() + " " + long)]
    docs += [(120 + i, text(40) + " " + passage + " " + text(40)) for i in range(4)]  # a passage that repeats
    docs += [(130 + i, text(40) + " " + items[i][1] + " " + text(40)) for i in range(5)]  # leaks
    docs += [(140, "few words"), (141, "same words again and " * 40), (142, None), (143, "")]
    table = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(d, 1, 0) for d, _ in clean[:30]] , "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    after, now = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, now, folder)
        if name != "packing":
            assert out.columns == table.columns and out.dtypes == table.dtypes
        out.write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        after[name] = {r.doc_id: r for r in now.collect()}
    ids = {name: set(r) for name, r in after.items()}
    good = {d for d, _ in clean}
    assert ids["quality_rules"] == {d for d, _ in docs} - {140, 141, 142, 143}
    classes = class_of({d: fingerprint(t) for d, t in docs if d in ids["quality_rules"]}, 4)
    assert ids["near_dedup"] == set(classes.values())
    assert good <= ids["near_dedup"] and not ids["near_dedup"] & {*range(100, 105), 150, 151}
    cut = after["substring_dedup"]
    assert ids["substring_dedup"] == ids["near_dedup"]
    assert all(cut[d].text == t and cut[d].n_chars == len(t) for d, t in clean)
    assert len(words(cut[120].text)) == 140 and [len(words(cut[d].text)) for d in (121, 122, 123)] == [80] * 3
    assert all(cut[d].n_chars == len(cut[d].text) for d in (121, 122, 123))
    assert ids["decontaminate"] == ids["substring_dedup"] - set(range(130, 135))
    assert ids["packing"] == ids["decontaminate"]

    empty = folder + "/empty"
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_run_and_registration(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert len([n for n in __spark_entry__.queries() if n.startswith("op")]) >= 10
    found = {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found and found < {d for (d,) in rows("documents", "doc_id")}
