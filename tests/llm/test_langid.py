import pytest
from pyspark.sql import functions as F

from lectern.llm import langid

WORDS = {"en": "the house of this water that thing with", "de": "der schnee und nicht über straße"}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, WORDS[lang], lang, lang) for k in range(8) for lang in WORDS]
    rows += [(90, "ignored", None, None), (91, None, "en", "x"), (92, "123", "zz", "x")]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, gram string"))


def plain_counts(text):
    counts = {}
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for w in words:
        padded = f" {w} "
        for n in (1, 2, 3):
            for k in range(len(padded) - n + 1):
                g = padded[k : k + n]
                if g != " ":
                    counts[g] = counts.get(g, 0) + 1
    return counts


def test_ngrams_as_counted_plainly():
    text = "Über die  Straße, the-end 12 x\nÉté"
    grams, counts = langid.ngrams(text)

    def unpack(g):
        out = []
        while g:
            out.append(chr(g & (1 << 21) - 1))
            g >>= 21
        return "".join(reversed(out))

    assert {unpack(int(g)): int(n) for g, n in zip(grams, counts)} == plain_counts(text)


def test_out_of_place_distance():
    model = langid.Identifier([("a", 97, 0), ("a", 98, 1), ("b", 98, 0)], 4)
    grams, counts = langid.ngrams("a")
    own = langid.ranked(grams, counts, 4)
    away = sum(abs(k - 0) if g == 97 else 4 for k, g in enumerate(own))
    assert model.identify("a") == ("a", 1 - away / (4 * len(own)))


def test_cases(spark, model):
    rows = [(1, "the water"), (2, "über schnee"), (3, None), (4, ""), (5, "12 !? 3"), (6, "the water " * 50000)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    got = docs.select("doc_id", langid.identify(model, F.col("text"), spark).alias("f")).collect()
    assert {r[0]: r[1]["lang"] for r in got} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en"}
    assert all(0 <= r[1]["score"] <= 1 for r in got)


def test_nothing_learned(spark):
    none = spark.createDataFrame([], "text string, lang string")
    model = langid.train(none)
    docs = spark.createDataFrame([("abc",)], "text string")
    assert docs.select(langid.identify(model, F.col("text"), spark)["lang"]).first()[0] == "und"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = langid.op5_langid(spark, sf).where("held_out")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    right, n = got.join(docs, "doc_id").agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n > 0.98


def test_query_against_plain_profiles(spark):
    """All predictions of the query, by dictionaries of counts and one distance."""
    import zlib

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()

    def packed(gram):
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        return value

    def best(counts):
        return sorted(counts, key=lambda g: (-counts[g], packed(g)))[: langid.PROFILE]

    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs}
    sums = {}
    for r in docs:
        if r["lang"] is not None and not held[r["doc_id"]]:
            total = sums.setdefault(r["lang"], {})
            for g, n in plain_counts(r["text"]).items():
                total[g] = total.get(g, 0) + n
    ranks = {lang: {g: k for k, g in enumerate(best(c))} for lang, c in sums.items()}
    got = {r["doc_id"]: r for r in langid.op5_langid(spark, sf).collect()}
    for r in docs:
        own = best(plain_counts(r["text"]))
        away = {
            lang: sum(abs(k - p[g]) if g in p else langid.PROFILE for k, g in enumerate(own))
            for lang, p in ranks.items()
        }
        want = min(sorted(away), key=away.get) if own else "und"
        found = got[r["doc_id"]]
        assert (found["lang_pred"], found["held_out"]) == (want, held[r["doc_id"]])
        assert found["score"] == pytest.approx(1 - away[want] / (langid.PROFILE * len(own)) if own else 0)


def test_profiles_are_cut_in_every_task(spark):
    rows = spark.createDataFrame([("the house", "en")], "text string, lang string")
    plan = langid.profiles(rows, "lang", "text")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_empty_table_ties_and_repeated_rows(spark, model):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.keep_identified(empty).count() == 0
    rows = [(1, "zzz qqq", "en"), (1, "zzz qqq", "en"), (1, "the water", "en"), (1, "the water", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = docs.select(langid.identify(model, F.col("text"), spark)["lang"].alias("l")).collect()
    # no profile knows the first text's rarer n-grams best: of equal distances the first language wins
    assert len(got) == 4 and got[0] == got[1] and got[2]["l"] == "en"
    same = langid.Identifier([("b", 97, 0), ("a", 97, 0)], 4)
    assert same.identify("a")[0] == "a"
