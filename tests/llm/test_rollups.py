from pathlib import Path

import pytest

from lectern.llm.rollups import Rollup, counted, revision, signed, vocabulary_counter

SCHEMA = "doc_id long, text string, lang string, source string, tokens string"
ROWS = [
    (1, "a b, c", "en", "s", "x"), (2, None, "en", "s", "x"), (3, "", None, None, "x"),
    (4, "é ß!", "de", "s", "x"), (4, "é ß!", "de", "s", "x"), (5, "w " * 70000, "en", "t", "x"),
]


def totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_counts(spark, docs):
    rollup = Rollup(spark)
    assert rollup.commit("1", signed(counted(docs), 1))
    got = totals(rollup)
    assert got["s", "en", "words-1"] == (2, 3) and got["s", "en", "pieces-1"] == (2, 4)
    assert got["s", "de", "words-1"] == (2, 4) and got["s", "de", "pieces-1"] == (2, 6)
    assert got[None, None, "words-1"] == (1, 0) and got["t", "en", "words-1"] == (1, 70000)


def test_same_batch_twice_counts_once(spark, docs):
    rollup = Rollup(spark)
    rows = signed(counted(docs), 1)
    assert rollup.commit("a/b %20", rows)
    before = totals(rollup)
    assert not rollup.commit("a/b %20", rows)
    rollup.compact()
    assert not rollup.commit("a/b %20", rows)
    assert totals(rollup) == before
    rollup.compact()
    assert totals(rollup) == before


def test_a_batch_that_broke_off_is_written_anew(spark, docs):
    rollup = Rollup(spark)
    rollup.commit("1", signed(counted(docs), 1))
    whole = totals(rollup)
    (marker,) = Path(rollup.folder.removeprefix("file:")).glob("batches/1/_SUCCESS")
    marker.unlink()
    assert totals(rollup) == {}
    assert rollup.commit("1", signed(counted(docs), 1))
    assert totals(rollup) == whole


def test_deltas_equal_a_recount(spark, docs):
    rollup = Rollup(spark)
    new = spark.createDataFrame([(1, "a b c d", "fr", "s", "x")], SCHEMA)
    rollup.commit("in", signed(counted(docs), 1))
    rollup.commit("out", signed(counted(docs.where("doc_id = 4")), -1))
    rollup.compact()
    rollup.commit("new", revision(counted(docs.where("doc_id = 1")), counted(new)))
    plain = Rollup(spark)
    left = docs.where("doc_id not in (1, 4)").unionByName(new)
    plain.commit("all", signed(counted(left), 1))
    assert totals(rollup) == totals(plain)


def test_empty(spark, docs):
    rollup = Rollup(spark)
    assert totals(rollup) == {}
    rollup.commit("none", signed(counted(docs.where("false")), 1))
    rollup.compact()
    assert totals(rollup) == {}


def test_public_vocabulary(spark, docs):
    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not Path(path).exists():
        pytest.skip("needs the vocabulary files")
    tokenizers = pytest.importorskip("tokenizers")
    got = counted(docs, {"bpe": vocabulary_counter(path, spark)}, keep=("doc_id",)).collect()
    plain = tokenizers.Tokenizer.from_file(path)
    expected = [(r[0], len(plain.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS]
    assert sorted((r["doc_id"], r["tokens"]) for r in got) == sorted(expected)


def test_a_batch_committed_during_compaction_counts_once(spark, docs, monkeypatch):
    rollup = Rollup(spark)
    rollup.commit("1", signed(counted(docs), 1))
    summed = Rollup._totals

    def late(self, base, batches):
        monkeypatch.setattr(Rollup, "_totals", summed)
        rollup.commit("2", signed(counted(docs), 1))
        return self._totals(base, batches)

    monkeypatch.setattr(Rollup, "_totals", late)
    rollup.compact()
    assert totals(rollup)["s", "en", "words-1"] == (4, 6)
    rollup.clean()
    assert totals(rollup)["s", "en", "words-1"] == (4, 6)
    rollup.compact()
    rollup.clean()
    assert totals(rollup)["s", "en", "words-1"] == (4, 6)
    assert not rollup.commit("1", signed(counted(docs), 1))
    names = [p.name for p in Path(rollup.folder.removeprefix("file:")).glob("*/*")]
    assert sorted(names) == ["00000001", "00000001"]
