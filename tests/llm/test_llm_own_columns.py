"""Filters give back the columns of their input, also those they have names of their own for."""

from collections import Counter

from clipcurate.llm import decontaminate, langid, near_dedup, toxicity
from clipcurate.llm.subword import train

TAKEN = (
    "toxic_pred", "toxic_score", "offending", "lang_pred", "lang_score", "lang_rejected", "_id", "_x", "n_hit", "n_words",
    "contaminated", "hit_spans", "_cut", "items_sha256", "N_ITEMS",
)
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def documents(spark):
    texts = ["the of and in to a", "der die das und ist", None, "", "x" * 300_000, "the of and in to a", f"before {PASSAGE} after"]
    rows = [(i, t, *[f"{c}-{i}" for c in TAKEN]) for i, t in enumerate(texts)] + [(None, "is and the", *TAKEN)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in TAKEN))


def own(df):
    return Counter(tuple(r[c] for c in TAKEN) for r in df.collect())


def test_values_of_clashing_columns_stay(spark):
    docs = documents(spark)
    whole = own(docs)
    examples = [(Counter([b"the", b"and"]), "en"), (Counter([b"der", b"und"]), "de")] * 20
    sample = [("you vile thing. " + "fine day. " * (i % 4), 1) if i % 2 else ("fine day. " * (1 + i % 4), 0) for i in range(60)]
    benchmark = spark.createDataFrame([("b", PASSAGE)], "item_id string, text string")
    for found in (
        toxicity.keep_clean(docs, toxicity.learn(sample)),
        langid.keep_identified(docs, train(examples, langid.SPACE, epochs=2)),
        near_dedup.keep_one(docs),
        decontaminate.remove(docs, benchmark, most_covered=1.0),
    ):
        assert found.columns == docs.columns
        values = own(found)
        assert values and all(n <= whole[v] for v, n in values.items())
    cut = {r.doc_id: r.text for r in decontaminate.remove(docs, benchmark, most_covered=1.0).collect()}
    assert PASSAGE not in cut[6] and cut[6].startswith("before") and cut[2] is None and cut[3] == ""
    assert own(decontaminate.remove(docs, benchmark, most_covered=1.0)) == whole
    assert own(near_dedup.keep_one(docs.limit(0))) == Counter()
