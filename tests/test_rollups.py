import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from lectern.operators.rollups import member_lists, packed_lists
from lectern.plans import exams

SCORES = "-1 0 20 20.1 40 59 59.5 60 60.1 80 100 100.1".split()


def answers(spark, n=800, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        paper = r.choice([1] * 5 + [2, 3, 4, 5])
        # paper 4 has only fails, 5 only passes; paper 1 has two names
        pool = {4: ["0", "59"], 5: ["60", "100"]}.get(paper, SCORES)
        score = r.choice([*pool, None])
        name = r.choice(["p", "q"]) if paper == 1 else f"p{paper}"
        rows.append(
            (
                r.randrange(50), paper, name, None if score is None else Decimal(score),
                r.randrange(600), r.randrange(6), r.choice([0, 1, 2]), "20190722",
                r.choice(["a", "b"]),
            )
        )
    # a question with only right and one with only wrong answers
    rows += [(1, 9, "s", Decimal(70), 1, 77, 1, "20190722", "a")] * 2
    rows += [(1, 9, "s", Decimal(70), 1, 78, 0, "20190722", "a")]
    df = spark.createDataFrame(
        rows,
        "userid int, paperviewid int, paperviewname string, score decimal(22,1), spendtime int,"
        " questionid int, user_question_answer int, dt string, dn string",
    )
    return rows, df


def half_up(value, step):
    return Decimal(value).quantize(Decimal(step), ROUND_HALF_UP)


@pytest.mark.parametrize(
    "boundary, fails, passes",
    [
        ("service", lambda s: 0 <= s <= 59, lambda s: s >= 60),
        ("dao", lambda s: 0 <= s <= 60, lambda s: s > 60),
        ("closed", lambda s: 0 <= s < 60, lambda s: s >= 60),
    ],
)
def test_pass_rates(spark, rows, boundary, fails, passes):
    given, df = answers(spark)
    failed, passed = Counter(), Counter()
    for _, paper, name, score, *_, dt, dn in given:
        if score is not None and fails(score):
            failed[paper, name, dt, dn] += 1
        if score is not None and passes(score):
            passed[paper, dn] += 1
    want = []
    for (paper, name, dt, dn), n in failed.items():
        m = passed[paper, dn]
        if m:
            want.append((paper, name, n, m, half_up(Decimal(m) / (m + n), "0.01"), dt, dn))
    assert rows(exams.pass_rates(df, boundary)) == sorted(want, key=repr)
    assert exams.pass_rates(df, boundary, keep_one_sided=True).count() > len(want)


def test_question_errors(spark, rows):
    given, df = answers(spark)
    wrong = Counter((r[5], r[7], r[8]) for r in given if r[6] == 0)
    right = Counter((r[5], r[7], r[8]) for r in given if r[6] == 1)
    want = [
        (q, wrong[k], right[k], half_up(Decimal(wrong[k]) / (wrong[k] + right[k]), "0.01"), *k[1:])
        for k in wrong
        if right[k]
        for q in [k[0]]
    ]
    assert rows(exams.question_errors(df)) == sorted(want, key=repr)
    questions = {r.questionid for r in exams.question_errors(df, keep_one_sided=True).collect()}
    assert {77, 78} <= questions
    errors = [r.errcount for r in exams.question_errors(df).collect()]
    assert errors == sorted(errors, reverse=True)


def test_averages_and_extremes(spark):
    given, df = answers(spark)
    groups = defaultdict(list)
    for r in given:
        groups[r[1], r[2], r[7], r[8]].append((r[3], r[4]))
    for row in exams.paper_averages(df, ordered=True).collect():
        group = groups[row.paperviewid, row.paperviewname, row.dt, row.dn]
        scores = [s for s, _ in group if s is not None]
        assert row.avgscore == half_up(half_up(sum(scores) / len(scores), "0.00001"), "0.1")
        spent = Decimal(sum(t for _, t in group)) / len(group)
        assert row.avgspendtime == half_up(spent, "0.01")
    for row in exams.paper_extremes(df).collect():
        group = groups[row.paperviewid, row.paperviewname, row.dt, row.dn]
        scores = [s for s, _ in group if s is not None]
        assert (row.maxscore, row.minscore) == (max(scores), min(scores))


def test_score_segments_are_whole(spark):
    given, df = answers(spark)
    edges = [(0, 20), (20, 40), (40, 60), (60, 80), (80, 100)]

    def segment(s):
        if s is None:
            return None
        for lo, hi in edges:
            if (lo < s or lo == s == 0) and s <= hi:
                return f"{lo}-{hi}"
        return None

    want = defaultdict(list)
    for user, paper, name, score, *_, dt, dn in given:
        want[paper, name, segment(score), dt, dn].append(user)
    for buckets in (1, 7):
        got, parts = defaultdict(list), Counter()
        for r in exams.score_segments(df, buckets).collect():
            key = (r.paperviewid, r.paperviewname, r.score_segment, r.dt, r.dn)
            got[key] += map(int, r.userids.split(","))
            parts[key] += 1
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        assert (max(parts.values()) > 1) == (buckets == 7)
    counts = {
        (r.paperviewid, r.paperviewname, r.score_segment, r.dt, r.dn, r.userid): r.copies
        for r in exams.segment_users(df).collect()
    }
    assert counts == Counter((*k, u) for k, users in want.items() for u in users)


def parts_of(spark, users, buckets):
    df = spark.createDataFrame([("g", u) for u in users] + [("empty", None)], "k string, u int")
    got = member_lists(df, ["k"], "u", "us", buckets).collect()
    assert [(r.part, r.us) for r in got if r.k == "empty"] == [(0, "")]
    return {r.part: [int(x) for x in r.us.split(",")] for r in got if r.k == "g"}


def test_member_lists_split_a_hot_member(spark):
    parts = parts_of(spark, [*[5] * 200_000, None], 20)
    assert sum(map(len, parts.values())) == 200_000
    # pieces of a thousand copies, ten to a part on average
    assert len(parts) == 20 and max(map(len, parts.values())) <= 25_000


def test_member_lists_split_a_hot_group(spark):
    parts = parts_of(spark, range(20_000), 20)
    assert sorted(x for part in parts.values() for x in part) == list(range(20_000))
    assert max(map(len, parts.values())) < 2 * 1000


def test_a_growing_group_moves_no_row(spark):
    small, large = parts_of(spark, range(500), 8), parts_of(spark, range(5000), 8)
    for part, members in small.items():
        assert set(members) <= set(large[part])


def test_no_row_is_ranked_or_listed_in_one_piece(spark):
    _, df = answers(spark)
    plan = exams.score_segments(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def packed(spark, users, max_bytes, schema="k string, u long"):
    df = spark.createDataFrame([("g", u) for u in users] + [("empty", None), (None, 7)], schema)
    got = packed_lists(df, ["k"], "u", "us", max_bytes).collect()
    assert sorted((r.part, r.us) for r in got if r.k != "g") == [(0, ""), (0, "7")]
    return {r.part: [int(x) for x in r.us.split(",")] for r in got if r.k == "g"}


def plainly_packed(users, max_bytes):
    parts, at = defaultdict(list), 0
    for u in sorted(x for x in users if x is not None):
        parts[at // max_bytes].append(u)
        at += len(str(u)) + 1
    return dict(parts)


def test_packed_lists_against_one_by_one(spark):
    users = [*range(-30, 20_000, 7), *[5000] * 3000, *[2**40 + 3] * 9, None, 0, 0]
    for max_bytes in (16, 100, 5000):
        assert packed(spark, users, max_bytes) == plainly_packed(users, max_bytes)


def test_packed_rows_stay_under_the_bound(spark):
    """Rows are bounded whatever the size of a group, and no window holds a whole group."""
    df = spark.range(10_000_000).selectExpr("'g' AS k", "id AS u")
    rows = packed_lists(df, ["k"], "u", "us", 1 << 20)
    sizes = [r[0] for r in rows.selectExpr("length(us)").collect()]
    # all digits and commas of the numbers, less one comma a row
    assert sum(sizes) + len(sizes) == sum(9 * 10 ** d * (d + 1) for d in range(7)) + 1 + 10_000_000
    assert max(sizes) <= (1 << 20) + 8 and len(sizes) == -(-(sum(sizes) + len(sizes)) // (1 << 20))
