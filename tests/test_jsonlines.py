from decimal import Decimal

from lectern.plans.ingest import cleaned, ingest, members_from_json
from lectern.sources import CLEANED, Lake, clean, json_objects
from lectern.sources.jsonlines import rejected

GOOD = {
    '{"uid":1}': "1",
    '  {"uid":2}  ': "2",
    "{'uid':3}": "3",
    "{uid:4}": "4",
    '{"uid":"5"}': "5",
    '{"uid":"x"}': "x",
    '{"uid":12.7}': "12.7",
    "{}": None,
    '{"uid":null}': None,
    '{"uid":{"a":1}}': '{"a":1}',
}
BAD = [
    '{"uid":5', "junk", "", "null", "[1]", '[{"uid":1}]', '{"uid":1} trailing', '{"uid":1} x}',
    '{"uid":1}} x}', '{"uid":1},{"uid":2}', '{"uid":1},"x":{}', "12", '"text"',
]


def lines_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_only_whole_objects_are_kept(spark):
    got = json_objects(lines_of(spark, [*GOOD, *BAD]), ["uid"])
    assert sorted(map(str, (r.uid for r in got.collect()))) == sorted(map(str, GOOD.values()))
    for line in BAD:
        assert json_objects(lines_of(spark, [line]), ["uid"]).count() == 0, line


def test_lenient_parse_keeps_a_row_per_line(spark):
    got = json_objects(lines_of(spark, [*GOOD, *BAD]), ["uid"], strict=False)
    assert got.count() == len(GOOD) + len(BAD)


def test_a_line_is_parsed_once(spark):
    plan = clean(lines_of(spark, ["{}"]), CLEANED["dwd_member"])._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("from_json") == 1


def test_member_log(spark):
    lines = lines_of(
        spark,
        [
            '{"uid":"7","fullname":"王五","phone":"13712345678","password":"p","paymoney":1.5,'
            '"dt":"20190722","dn":"a"}',
            '{"uid":"bad","ad_id":3,"dn":"b"}',
        ],
    )
    df = clean(lines, CLEANED["dwd_member"])
    assert df.schema.fieldNames() == CLEANED["dwd_member"].columns
    a, b = sorted(df.collect(), key=lambda r: r.dn)
    assert (a.uid, a.ad_id, a.fullname, a.phone, a.password, a.paymoney, a.dt) == (
        7, 0, "王XX", "137*****5678", "******", "1.5", "20190722",
    )
    assert (b.uid, b.ad_id, b.fullname, b.phone, b.password, b.dt) == (
        0, 3, None, None, "******", None,
    )


def test_odd_keys_and_labels(spark):
    reg = clean(
        lines_of(spark, ['{"uid":1,"webA":"w","regsource":"4"}', '{"uid":2}']),
        CLEANED["dwd_member_regtype"],
    )
    got = {r.uid: (r.domain, r.regsource, r.regsourcename) for r in reg.collect()}
    assert got == {1: ("w", "4", "WeChat"), 2: (None, None, "other")}
    course = clean(lines_of(spark, ['{"sequnece":"9"}']), CLEANED["dwd_qz_course"])
    assert course.first().sequence == "9"
    link = clean(lines_of(spark, ['{"questtype":5}']), CLEANED["dwd_qz_point_question"])
    assert link.first().questype == 5


def test_scores(spark):
    df = clean(
        lines_of(spark, ['{"questionid":1,"score":83.85}', '{"questionid":2}']),
        CLEANED["dwd_qz_question"],
    )
    assert {r.questionid: r.score for r in df.collect()} == {1: Decimal("83.9"), 2: None}


def test_every_spec_has_its_schema(spark):
    assert len(CLEANED) == 23
    for spec in CLEANED.values():
        df = clean(lines_of(spark, ["{}", "junk"]), spec)
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in spec.schema
        ]
        assert df.count() == 1


def test_json_source_variant(spark, tmp_path):
    (tmp_path / "member.log").write_text(
        '{"uid":"1","fullname":"Bob","phone":"13712345678"}\n', encoding="utf-8"
    )
    row = members_from_json(spark, str(tmp_path / "member.log")).first()
    assert (row.uid, row.fullname, row.phone, row.password) == ("1", "BXX", "137*****678", "******")


def test_ingest_again_gives_the_same_table(spark, tmp_path):
    raw, root = tmp_path / "raw", tmp_path / "lake"
    raw.mkdir()
    (raw / "baseadlog.log").write_text(
        '{"adid":1,"adname":"x_y","dn":"a"}\njunk\n{"adid":1,"adname":"z","dn":"b"}\n'
    )
    lake = Lake(spark, str(root))
    spec = CLEANED["dwd_base_ad"]
    for _ in range(2):
        ingest(lake, str(raw), ["dwd_base_ad"])
    assert cleaned(spark, str(raw), "dwd_base_ad").count() == 2
    assert lake.read("dwd_base_ad", spec.schema).count() == 2
    ingest(lake, str(raw), ["dwd_base_ad"], append=True)
    assert lake.read("dwd_base_ad", spec.schema).count() == 4


REJECTED = {
    "": "blank", "   ": "blank", "junk": "malformed", '{"uid":5': "malformed", "null": "no object", "[1]": "no object",
    '[{"uid":1}]': "no object", '{"uid":1},{"uid":2}': "more than one", '{"uid":1}],[{"uid":2}': "more than one",
}


def test_reasons(spark):
    lines = lines_of(spark, [*GOOD, *BAD, *REJECTED])
    got = {r.value: r.reason for r in rejected(lines).collect()}
    assert set(got) == {*BAD, *REJECTED}
    assert {v: got[v] for v in REJECTED} == REJECTED


def test_rejected_lines_are_counted_and_kept(spark, tmp_path, rows):
    raw, lake = tmp_path / "raw", Lake(spark, str(tmp_path / "lake"))
    good = '{"adid":1,"adname":"x","dn":"a"}'
    lines_of(spark, [good, good, *REJECTED]).coalesce(2).write.text(str(raw / "baseadlog.log"))
    for _ in range(2):
        counts = ingest(lake, str(raw), ["dwd_base_ad"], keep_rejects=True)
        assert counts == {
            "dwd_base_ad": {"lines": 11, "blank": 2, "malformed": 2, "no object": 3, "more than one": 2}
        }
        kept = spark.read.parquet(lake.path("rejected_lines"))
        assert rows(kept, "value", "reason", "log") == sorted(
            ((v, r, "dwd_base_ad") for v, r in REJECTED.items()), key=repr
        )
    assert lake.read("dwd_base_ad", CLEANED["dwd_base_ad"].schema).count() == 2
    lines_of(spark, [good]).write.mode("overwrite").text(str(raw / "baseadlog.log"))
    counts = ingest(lake, str(raw), ["dwd_base_ad"], keep_rejects=True)
    assert counts["dwd_base_ad"]["lines"] == 1 and sum(counts["dwd_base_ad"].values()) == 1
    assert spark.read.parquet(lake.path("rejected_lines")).count() == 0


def test_a_batch_sent_twice_is_counted_once(spark, tmp_path):
    raw, lake = tmp_path / "raw", Lake(spark, str(tmp_path / "lake"))
    lines_of(spark, ['{"adid":1,"dn":"a"}', "junk"]).write.text(str(raw / "baseadlog.log"))
    first = ingest(lake, str(raw), ["dwd_base_ad"], batch="b")
    assert first["dwd_base_ad"]["malformed"] == 1
    assert ingest(lake, str(raw), ["dwd_base_ad"], batch="b") == {"dwd_base_ad": {}}
