"""Look-ups of op7: few for each text, and none of the windows lost."""

from pyspark.sql import functions as F

from wattledger.llm import decontamination


def test_a_text_is_looked_up_at_every_fifth_word_only(spark):
    w = F.split(F.lit(" ".join(f"w{i}" for i in range(100))), " ")
    n = spark.range(1).select(F.size(decontamination._probes(w, 10))).first()[0]
    assert n <= 20


def test_items_of_any_length_are_found_at_any_place(spark):
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, 14)]
    rows, want = [], {}
    for n, text in items:
        for before in range(7):
            for after in (0, 3):
                key = 1000 * n + 10 * before + after
                rows.append((key, " ".join(["pre"] * before + [text] + ["post"] * after)))
                want[key] = (before + n + after, n, 1)
        # An item without its last word has a window only if it has ten words then.
        rows.append((1000 * n + 99, text.rsplit(" ", 1)[0] if n > 1 else "other"))
        kept = n - 1 if n > 10 else 0
        want[1000 * n + 99] = (max(n - 1, 1), kept, int(kept > 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(docs, bench).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"]) for r in got} == want
    assert len(got) == len(rows)


def test_grams_and_windows_joined_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "a b c"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "b c d e f g h i j k")], "item_id long, text string")
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    got = decontamination.contamination(docs, bench).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in got} == {1: (12, 10), 2: (3, 0), 3: (0, 0)}
