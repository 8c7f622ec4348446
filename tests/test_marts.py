"""Edge cases of the marts, and their plans against brute force in plain Python."""

from __future__ import annotations

import datetime as dt
import random
import re
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from martloom.functions.exact import as_int, as_numeric, mean_2dp, micros_between
from martloom.operators import quality
from martloom.operators.moderation_stats import moderation_stats
from martloom.operators.product_popularity import (
    product_popularity,
    product_recommendations,
    product_reviews,
    product_views,
)
from martloom.operators.support_efficiency import support_efficiency
from martloom.operators.user_activity import session_durations, user_activity
from martloom.schemas import PRODUCT_POPULARITY

DAY = dt.date(2024, 1, 10)
NINE = dt.datetime(2024, 1, 10, 9)
SESSION = (
    "session_id string, user_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "pages_visited array<string>, device string, actions array<string>"
)
TICKET = (
    "ticket_id string, user_id string, status string, issue_type string, messages string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)
REVIEW = (
    "review_id string, user_id string, product_id string, rating int, moderation_status string, "
    "flags array<string>, submitted_at timestamp_ntz"
)
ADVICE = "user_id string, recommended_products array<string>, last_updated timestamp_ntz"


def later(minutes=0, **more):
    return NINE + dt.timedelta(minutes=minutes, **more)


def sessions(spark, *rows):
    """(end, pages, device, actions[, user]) from 09:00 on."""
    filled = [
        (f"s{n}", r[4] if len(r) > 4 else "u", NINE, r[0], r[1], r[2], r[3])
        for n, r in enumerate(rows)
    ]
    return spark.createDataFrame(filled, SESSION)


def one(df):
    (row,) = df.collect()
    return row


def half_up(value) -> Decimal:
    return Decimal(value).quantize(Decimal("0.01"), ROUND_HALF_UP)


# --- user_activity -----------------------------------------------------------


@pytest.mark.parametrize("nothing", [None, []])
def test_session_without_pages_and_actions(spark, nothing):
    row = one(user_activity(sessions(spark, (None, nothing, "tv", nothing))))
    assert (row["total_sessions"], row["total_pages_visited"], row["total_actions"]) == (1, 0, 0)
    assert row["unique_pages_visited"] == 0 and row["most_frequent_action"] is None
    assert row["avg_session_duration_minutes"] == Decimal("0.00") and row["last_activity"] is None


def test_negative_duration_is_averaged(spark):
    row = one(user_activity(sessions(spark, (later(-10), [], "a", []), (later(-5), [], "a", []))))
    assert row["avg_session_duration_minutes"] == Decimal("-7.50")


def test_mode_tie_and_weight(spark):
    tie = sessions(spark, (None, [], "a", ["b", "a"]), (None, [], "a", ["a", "b", None, None, None]))
    assert one(user_activity(tie))["most_frequent_action"] == "a"
    weighted = sessions(spark, (None, ["p"] * 3, "a", ["x"]), (None, ["p"], "a", ["y", "y"]))
    assert one(user_activity(weighted))["most_frequent_action"] == "x"
    assert one(user_activity(weighted, "plain"))["most_frequent_action"] == "y"


def test_byte_order_of_actions_and_devices(spark):
    frame = sessions(spark, (None, [], "b", ["a"]), (None, [], "B", ["B"]), (None, [], None, []))
    row = one(user_activity(frame))
    assert row["most_frequent_action"] == "B" and row["devices_used"] == ["B", "b", None]


def test_only_unnamed_devices(spark):
    assert one(user_activity(sessions(spark, (None, [], None, []))))["devices_used"] == [None]


def test_huge_session_is_not_crossed(spark):
    row = one(user_activity(sessions(spark, (later(2), ["p"] * 1000, "a", ["x"] * 1000))))
    assert row["total_pages_visited"] == 1000**3 and row["total_actions"] == 1000**3
    with pytest.raises(Exception, match="total_pages_visited: integer out of range"):
        user_activity(sessions(spark, (None, ["p"] * 2000, "a", ["x"] * 1000))).collect()


def test_unknown_counting(spark):
    with pytest.raises(ValueError, match="counting"):
        user_activity(sessions(spark, (None, [], "a", [])), "other")


def crossed(rows, product=True):
    """The literal product of pages and actions, row by row."""
    groups = defaultdict(list)
    for sid, user, start, end, pages, device, actions in rows:
        if product:
            pairs = [(p, a) for p in (pages or [None]) for a in (actions or [None])]
        else:
            pairs = [(None, None)]
        groups[start.date(), user].append((sid, start, end, pages, device, actions, pairs))
    result = []
    for (day, user), members in groups.items():
        micros, timed, n_pages, n_actions, acted = 0, 0, 0, 0, Counter()
        for _, start, end, pages, _, actions, pairs in members:
            weight = len(pairs)
            if end is not None:
                micros += weight * ((end - start) // dt.timedelta(microseconds=1))
                timed += weight
            n_pages += weight * len(pages or [])
            n_actions += weight * len(actions or [])
            acted.update(
                [a for _, a in pairs if a is not None]
                if product
                else [a for a in actions or [] if a is not None]
            )
        named = {m[4] for m in members}
        ends = [m[2] for m in members if m[2] is not None]
        result.append(
            (
                day,
                user,
                len(members),
                half_up(Decimal(micros) / (timed * 60_000_000)) if timed else Decimal("0.00"),
                n_pages,
                len({p for m in members for p in m[3] or [] if p is not None}),
                n_actions,
                min(acted, key=lambda a: (-acted[a], a)) if acted else None,
                sorted(d for d in named if d is not None) + [None] * (None in named),
                max(ends) if ends else None,
            )
        )
    return sorted(result)


@pytest.mark.parametrize("counting", ["product", "plain"])
def test_user_activity_equals_the_literal_product(spark, counting):
    pick = random.Random(7)

    def array(values):
        kind = pick.random()
        if kind < 0.15:
            return None
        return [] if kind < 0.3 else [pick.choice(values) for _ in range(pick.randint(1, 5))]

    rows = []
    for n in range(600):
        start = NINE + dt.timedelta(hours=pick.randint(0, 60), microseconds=pick.randint(0, 10**6))
        end = start + dt.timedelta(microseconds=pick.randint(-(10**9), 10**10))
        # One user has a third of all sessions.
        user = "hot" if n % 3 == 0 else f"u{pick.randint(0, 12)}"
        rows.append(
            (f"s{n}", user, start, pick.choice([end, end, None]), array(["/a", "/b", "/c", None]),
             pick.choice(["tv", "pc", None]), array(["x", "y", "z", None]))
        )
    frame = spark.createDataFrame(rows, SESSION).repartition(5)
    got = sorted(tuple(r)[:-1] for r in user_activity(frame, counting).collect())
    assert got == crossed(rows, counting == "product")


def test_session_durations(spark):
    got = session_durations(sessions(spark, (later(1, seconds=30), [], "a", []), (None, [], "a", [])))
    assert [tuple(r) for r in got.orderBy("session_id").collect()] == [
        ("s0", 90_000_000, Decimal("1.50")),
        ("s1", None, None),
    ]


def test_durations_ignore_the_session_zone(spark):
    # The session's zone skips an hour that night.
    frame = spark.sql(
        "select timestamp_ntz'2024-03-10 00:00:00' a, timestamp_ntz'2024-03-10 12:00:00.000001' b"
    )
    assert int(one(frame.select(micros_between(frame["a"], frame["b"]).alias("x")))["x"]) == (
        12 * 3_600_000_000 + 1
    )


# --- support_efficiency ------------------------------------------------------


def tickets(spark, *rows):
    filled = [(f"t{n}", r[0], r[1], "pay", r[2], NINE, r[3]) for n, r in enumerate(rows)]
    return spark.createDataFrame(filled, TICKET)


def test_support_efficiency(spark):
    frame = tickets(
        spark,
        ("a", "closed", "[1,2]", later(90)),
        ("a", "closed", "[]", later(30)),
        ("b", "closed", None, NINE),  # not later than its creation: no resolution time
        ("b", "closed", None, later(-5)),
        ("c", "open", "[{}]", later(500)),
        ("d", "pending", "[]", None),
    )
    row = one(support_efficiency(frame))
    assert tuple(row)[:-1] == (
        DAY, "pay", 6, 1, 4, Decimal("1.00"), Decimal("1.50"), Decimal("0.50"), 3, 4
    )


def test_no_resolution_time(spark):
    row = one(support_efficiency(tickets(spark, ("a", "open", "[]", None))))
    assert tuple(row)[5:8] == (Decimal("0.00"),) * 3


@pytest.mark.parametrize("messages", ["null", "{}", '"x"', "5"])
def test_messages_must_be_an_array(spark, messages):
    with pytest.raises(Exception, match="not a JSON array"):
        support_efficiency(tickets(spark, ("a", "open", messages, None))).collect()


# --- moderation_stats --------------------------------------------------------


def reviews(spark, *rows):
    """(user, product, rating, status, flags[, submitted])"""
    filled = [
        (f"r{n}", r[0], r[1], r[2], r[3], r[4], r[5] if len(r) > 5 else NINE)
        for n, r in enumerate(rows)
    ]
    return spark.createDataFrame(filled, REVIEW)


@pytest.mark.parametrize(
    "ratings, mean", [([1, 2], "1.50"), ([1] * 7 + [2], "1.13"), ([None], None), ([-1] * 7 + [-2], "-1.13")]
)
def test_mean_rating_half_up(spark, ratings, mean):
    row = one(moderation_stats(reviews(spark, *[("u", "p", r, "x", None) for r in ratings])))
    assert row["avg_rating"] == (mean and Decimal(mean))
    assert row["total_flags"] == 0 and row["total_reviews"] == len(ratings)


def test_moderation_counts(spark):
    frame = reviews(
        spark,
        ("u", "p", 1, "approved", ["f", "g"]),
        ("v", "p", 0, "approved", []),
        (None, None, 2, "approved", None),
        ("u", "q", 5, "pending", ["f", None]),
    )
    got = sorted(tuple(r)[1:-1] for r in moderation_stats(frame).collect())
    assert got == [
        ("approved", 3, Decimal("1.00"), 2, 1, 2),
        ("pending", 1, Decimal("5.00"), 2, 1, 1),
    ]


def test_mean_rating_of_ten_overflows(spark):
    with pytest.raises(Exception, match="numeric field overflow"):
        moderation_stats(reviews(spark, ("u", "p", 10, "approved", None))).collect()


# --- product_popularity ------------------------------------------------------


def advice(spark, *rows):
    return spark.createDataFrame(list(rows), ADVICE)


def test_page_prefix_and_null_pages(spark):
    frame = sessions(spark, (None, ["/products/", "/products", "/products/a/b", "/home", None], "a", []))
    got = product_popularity(frame, reviews(spark), advice(spark)).collect()
    assert {r["product_id"]: r["total_views"] for r in got} == {
        "": 1, "/products": 1, "a/b": 1, "/home": 1
    }


def test_only_approved_reviews_count(spark):
    frame = reviews(
        spark,
        ("u", "p", 5, "approved", None),
        ("u", "p", 4, "approved", None),
        ("u", "p", 1, "rejected", None),
        ("u", "p", 1, "pending", None),
        ("u", None, 3, "approved", None),
    )
    row = one(product_popularity(sessions(spark), frame, advice(spark)))
    assert tuple(row)[:-1] == (DAY, "p", 0, 2, Decimal("4.50"), 0)
    by_product = {r["product_id"]: r for r in product_reviews(frame).collect()}
    assert by_product["p"]["reviews"] == 2 and by_product[None]["avg_rating"] == Decimal("3.00")


def test_colliding_pages_are_two_rows_that_fail_the_key_check(spark):
    frame = sessions(spark, (None, ["/products/42", "42", "42"], "a", []))
    mart = product_popularity(
        frame, reviews(spark, ("u", "42", 4, "approved", None)), advice(spark)
    )
    assert sorted(tuple(r)[1:-1] for r in mart.collect()) == [
        ("42", 1, 1, Decimal("4.00"), 0),
        ("42", 2, 1, Decimal("4.00"), 0),
    ]
    with pytest.raises(quality.ConstraintViolation, match="key_unique x1"):
        quality.check(mart, PRODUCT_POPULARITY, mode="fail")


def test_product_rating_of_ten_overflows(spark):
    with pytest.raises(Exception, match="avg_rating: numeric field overflow"):
        product_popularity(
            sessions(spark), reviews(spark, ("u", "p", 10, "approved", None)), advice(spark)
        ).collect()


def test_views_are_counted_by_element(spark):
    frame = sessions(spark, (None, ["/a", "/a", "/b"], "x", []), (None, ["/a"], "x", []))
    got = {r["page"]: r["views"] for r in product_views(frame).collect()}
    assert got == {"/a": 3, "/b": 1}
    got = product_recommendations(advice(spark, ("u", ["p", "p", None], NINE))).collect()
    assert {r["product_id"]: r["recommendations"] for r in got} == {"p": 2, None: 1}


def popularity_by_hand(visits, rated, advised):
    """Row by row: one row per view group, then what it did not take of the others."""
    views, reviews, advice_count = Counter(), {}, Counter()
    for v in visits:
        for page in v["pages_visited"] or []:
            views[(v["start_time"] and v["start_time"].date(), page)] += 1
    for r in rated:
        if r["moderation_status"] == "approved":
            key = (r["submitted_at"] and r["submitted_at"].date(), r["product_id"])
            n, total, known = reviews.get(key, (0, 0, 0))
            more = r["rating"] is not None
            reviews[key] = (n + 1, total + (r["rating"] or 0), known + more)
    for a in advised:
        for product in a["recommended_products"] or []:
            advice_count[(a["last_updated"] and a["last_updated"].date(), product)] += 1

    def row(key, seen, review, advised_times):
        n, total, known = review
        mean = half_up(Decimal(total) / known) if known else Decimal("0.00")
        return (*key, seen, n, mean, advised_times)

    none, taken, out = (0, 0, 0), set(), []
    for (day, page), seen in views.items():
        key = (day, None if page is None else re.sub("^/products/", "", page))
        matched = None not in key
        out.append(row(key, seen, reviews.get(key, none) if matched else none, advice_count[key] if matched and key in advice_count else 0))
        taken |= {key} if matched else set()
    for key in [*reviews, *(k for k in advice_count if k not in reviews or None in k)]:
        if key in taken:
            continue
        if None in key:
            # NULL never matches: each side keeps a row of its own.
            if key in reviews:
                out.append(row(key, 0, reviews.pop(key), 0))
            else:
                out.append(row(key, 0, none, advice_count[key]))
        else:
            out.append(row(key, 0, reviews.get(key, none), advice_count.get(key, 0)))
    return [r for r in out if r[1] is not None]


def test_popularity_equals_the_full_outer_joins(spark):
    """The literal form in Spark SQL, on inputs with NULL ids, NULL dates and colliding pages."""
    pick = random.Random(3)
    ids = ["1", "2", "3", "/home", None]
    pages = ["/products/1", "/products/2", "1", "/home", "/products//home", None]

    def moment():
        return pick.choice([NINE, NINE + dt.timedelta(days=1)])

    def maybe_moment():
        return pick.choice([moment(), moment(), None])

    visits = spark.createDataFrame(
        [
            (f"s{n}", "u", moment(), None,
             pick.choice([None, [], [pick.choice(pages) for _ in range(3)]]), "a", [])
            for n in range(30)
        ],
        SESSION,
    )
    rated = reviews(
        spark,
        *[
            ("u", pick.choice(ids), pick.choice([1, 4, 5, None]),
             pick.choice(["approved", "pending"]), None, maybe_moment())
            for _ in range(30)
        ],
    )
    advised = advice(
        spark, *[("u", pick.choice([None, [pick.choice(ids)] * 2]), maybe_moment()) for _ in range(20)]
    )
    expected = popularity_by_hand(visits.collect(), rated.collect(), advised.collect())
    got = [tuple(r)[:-1] for r in product_popularity(visits, rated, advised).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert any(d is None for d, *_ in got)


# --- rounding and narrowing --------------------------------------------------


def test_exact_rounding(spark):
    pick = random.Random(1)
    cases = [(pick.randint(-(10**12), 10**12), pick.randint(1, 10**6), u) for u in (1, 60) for _ in range(50)]
    cases += [(1005, 1000, 1), (-1005, 1000, 1), (5, 1000, 1), (10**30, 10**15, 1), (3, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(
        [(Decimal(t) if t is not None else None, n, u) for t, n, u in cases],
        "t decimal(38,0), n bigint, u int",
    )
    for unit in (1, 60):
        got = frame.filter(f"u = {unit}").select(
            "t", "n", mean_2dp(frame["t"], frame["n"], unit).alias("m")
        )
        for t, n, m in got.collect():
            assert m == (half_up(t / (n * unit)) if t is not None and n else None)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_narrowing_fails_in_any_mode(spark, ansi):
    frame = spark.sql("select 2147483647L a, 2147483648L b, 9.99BD c, -10.00BD d")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(frame.select(as_int(frame["a"], "a").alias("x")))["x"] == 2**31 - 1
        assert one(frame.select(as_numeric(frame["c"], 3, "c").alias("x")))["x"] == Decimal("9.99")
        for bad in (as_int(frame["b"], "b"), as_numeric(frame["d"], 3, "d")):
            with pytest.raises(Exception, match="out of range|overflow"):
                frame.select(bad.alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


# --- plans -------------------------------------------------------------------


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark):
    s, t = sessions(spark), tickets(spark)
    r, a = reviews(spark), advice(spark)
    popularity = plan_of(product_popularity(s, r, a))
    assert popularity.count("Exchange ") == 1 and "Join" not in popularity
    activity = plan_of(user_activity(s))
    assert activity.count("Exchange ") == 2 and "Join" not in activity
    # Distinct counts go through (group, value) before the group: a hot group is spread.
    support = plan_of(support_efficiency(t))
    assert support.count("Exchange ") == 2 and "issue_type#" in support
    moderation = plan_of(moderation_stats(r))
    assert moderation.count("Exchange ") == 2
    for text in (popularity, activity, support, moderation):
        for bad in ("CartesianProduct", "NestedLoop", "Window", "PythonUDF", "SinglePartition"):
            assert bad not in text
