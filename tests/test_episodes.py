import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyloom.functions import dates
from tallyloom.plans import episodes, scores

KEYS = ["subject"]
DAYS = "subject int, day date, owner string, score double, code string, start double, end double"
EP = ("start_date", "end_date", "start_flag", "end_flag")


def days(frame, *items):
    """``(day, kind)`` or ``(day, kind, owner)``: s start, e end, v visit."""
    out = []
    for item in items:
        day, kind, owner = (*item, "p")[:3]
        out.append((1, day, owner, None, "" if kind == "e" else "V", 1.0 * ("s" in kind), 1.0 * ("e" in kind)))
    return frame(DAYS, *out)


def built(frame, *items):
    return rows(episodes.build(episodes.pair(days(frame, *items), KEYS), KEYS), *EP)


def test_pairing_takes_the_latest_start_strictly_before(frame):
    d = days(frame, ("2024-01-01", "s"), ("2024-01-10", "s"), ("2024-01-10", "v"), ("2024-02-01", "e"), ("2024-03-01", "s"))
    d = d.filter("not (day = '2024-01-10' and start = 0)")
    assert rows(episodes.pair(d, KEYS), "start_date", "end_date") == [("2024-01-10", "2024-02-01"), ("2024-03-01", None)]


def test_end_on_the_start_day_does_not_close_it(frame):
    d = days(frame, ("2024-01-10", "se"))
    assert rows(episodes.pair(d, KEYS), "start_date", "end_date") == [("2024-01-10", None)]


def test_a_day_can_close_one_start_and_open_another(frame):
    d = days(frame, ("2024-01-01", "s"), ("2024-01-10", "se"))
    assert rows(episodes.pair(d, KEYS), "start_date", "end_date") == [("2024-01-01", "2024-01-10"), ("2024-01-10", None)]


def test_end_without_start_gives_nothing(frame):
    assert rows(episodes.pair(days(frame, ("2024-01-10", "e"), ("2024-01-11", "v")), KEYS)) == []


def test_near_ends_merge_into_the_last(frame):
    got = built(frame, ("2024-01-01", "s"), ("2024-02-01", "e"), ("2024-03-01", "e"), ("2024-04-30", "e"))
    assert got == [("2024-01-01", "2024-04-30", 1.0, 1.0)]  # 89 days after the first end


def test_far_end_opens_a_new_episode(frame):
    got = built(frame, ("2024-01-01", "s"), ("2024-02-01", "e"), ("2024-05-01", "e"))
    # 90 days: second end, third in sequence is not reached, so the start is first end + 90
    assert got == [("2024-01-01", "2024-02-01", 1.0, 1.0), ("2024-05-01", "2024-05-01", 1.2, 1.0)]


def test_far_end_followed_by_a_near_one_takes_the_next_end(frame):
    got = built(frame, ("2024-01-01", "s"), ("2024-02-01", "e"), ("2024-06-01", "e"), ("2024-06-15", "e"))
    assert got == [
        ("2024-01-01", "2024-02-01", 1.0, 1.0),
        ("2024-05-01", "2024-06-15", 1.2, 1.0),
        ("2024-05-01", "2024-06-15", 1.2, 1.0),
    ]


def test_third_end_far_from_the_last_starts_the_day_after_it(frame):
    got = built(frame, ("2024-01-01", "s"), ("2024-02-01", "e"), ("2024-02-10", "e"), ("2024-06-01", "e"))
    assert got == [("2024-01-01", "2024-02-10", 1.0, 1.0), ("2024-02-11", "2024-06-01", 1.2, 1.0)]


def test_open_start_closes_before_the_next_open_start(frame):
    got = built(frame, ("2024-01-01", "s"), ("2024-02-01", "e"), ("2024-03-01", "s"), ("2024-04-01", "s"))
    assert got == [
        ("2024-01-01", "2024-02-01", 1.0, 1.0), ("2024-03-01", "2024-03-31", 1.0, 1.1), ("2024-04-01", None, 1.0, 1.1),
    ]


def test_owner_of_start_and_end_must_agree(frame):
    assert built(frame, ("2024-01-01", "s", "a"), ("2024-02-01", "e", "b")) == []
    assert len(built(frame, ("2024-01-01", "s", "a"), ("2024-02-01", "e", "a"))) == 1


def test_pairing_equals_the_start_end_join(frame, spark):
    """Against the all-pairs definition, over random timelines."""
    import random

    rnd, out = random.Random(7), []
    for subject in range(30):
        for n in sorted(rnd.sample(range(1, 28), rnd.randint(1, 20))):
            out.append((subject, f"2024-01-{n:02d}", rnd.choice("ab"), None, "V", float(rnd.random() < 0.4), float(rnd.random() < 0.4)))
    d = frame(DAYS, *out)
    want = []
    for s in [r for r in out if r[5] > 0]:
        ends = [e for e in out if e[0] == s[0] and e[6] == 1 and s[1] < e[1]]
        if not ends:
            want.append((s[0], s[1], None))
        for e in ends:
            later = [x for x in out if x[0] == s[0] and x[5] > 0 and s[1] < x[1] < e[1]]
            if not later:
                want.append((s[0], s[1], e[1]))
    got = rows(episodes.pair(d, KEYS), "subject", "start_date", "end_date")
    assert sorted(got, key=str) == sorted(want, key=str)
    ep = episodes.build(episodes.pair(d, KEYS), KEYS, episodes.EpisodeRules(gap=5))
    assert ep.filter("end_date < start_date and end_flag <> 1.1").count() == 0


VISIT = "subject int, day date, owner string, score double, code string, start int"
END = "subject int, day date, owner string, score double, value string"


def test_days_collapse_and_restart(frame):
    visits = frame(
        VISIT, (1, "2024-01-01", "v1", 12.0, "90791", 1), (1, "2024-01-05", "v2", None, "90832", 0), (1, "2024-01-09", "v3", None, "90834", 0),
    )
    ends = frame(END, (1, "2024-01-05", "e1", 7.0, "End"), (1, "2024-01-05", "e2", 8.0, "End"))
    got = rows(episodes.collapse_days(visits, ends, KEYS), "day", "owner", "score", "code", "value", "start", "end")
    assert got == [
        ("2024-01-01", "v1", 12.0, "90791", "", 1.0, 0.0),
        ("2024-01-05", "v2", 8.0, "90832", "End", 0.0, 1.0),
        ("2024-01-09", "v3", None, "90834", "", 1.1, 0.0),
    ]


STATS = (
    "subject int, start_date date, end_date date, start_owner string, end_owner string, start_flag double, "
    "end_flag double, visits long, last_seen date, seen_score double, end_score double, first_score_day date, first_score double"
)


def stat(n, end, visits, seen, **kw):
    return (n, "2023-01-01", end, "p", None, 1.0, 1.0, visits, seen, kw.get("seen_score"), kw.get("end_score"), kw.get("first_day"), kw.get("first"))


def test_lost_to_follow_up_rules(frame):
    stats = frame(
        STATS,
        stat(1, "2023-05-10", 2, "2023-05-01"), stat(2, "2022-09-30", 9, "2022-09-01"),
        stat(3, None, 6, "2023-03-01"), stat(4, None, 5, "2023-03-01"), stat(5, None, 6, "2023-10-05"),
        stat(6, None, 6, "2021-09-30"), stat(7, None, 6, "2022-05-01"), stat(8, None, 6, "2023-03-03"),
    )
    got = rows(
        episodes.lost_to_follow_up(stats, dates.day("2024-01-03")), "subject", "end_date", "ltfu_date", "report_month", "lost"
    )
    assert got == [
        (1, "2023-05-10", None, "2023-05-01", "N"),
        (3, "2023-05-30", "2023-05-30", "2023-06-01", "Y"),
        (7, "2022-07-30", "2022-07-30", "2022-10-01", "Y"),
        (8, "2023-06-01", "2023-06-01", "2023-07-01", "Y"),  # a first of month moves on
    ]


def test_scores_of_an_episode(frame):
    d = frame(
        DAYS,
        (1, "2023-01-01", "p", None, "V", 1.0, 0.0), (1, "2023-01-08", "p", 20.0, "V", 0.0, 0.0),
        (1, "2023-02-01", "p", 9.0, "V", 0.0, 0.0), (1, "2023-03-01", "p", 4.0, "", 0.0, 1.0),
        (1, "2023-04-01", "p", 1.0, "V", 0.0, 0.0),
    )
    ep = frame(
        "subject int, start_date date, end_date date, start_owner string, end_owner string, start_flag double, end_flag double",
        (1, "2023-01-01", "2023-03-01", "p", "p", 1.0, 1.0), (1, "2023-01-01", None, "p", None, 1.0, 1.1), (1, "2024-01-01", None, "p", None, 1.0, 1.1),
    )
    st = episodes.episode_stats(ep, d, KEYS)
    got = rows(st, "end_date", "visits", "last_seen", "seen_score", "end_score", "first_score_day", "first_score")
    assert got == [
        ("2023-03-01", 3, "2023-02-01", 9.0, 4.0, "2023-01-08", 20.0),
        (None, 4, "2023-04-01", 1.0, None, "2023-01-08", 20.0),
    ]
    rep = episodes.lost_to_follow_up(st, dates.day("2024-01-01"), episodes.EpisodeRules(min_visits=1))
    assert rows(episodes.attach_scores(rep), "lost", "final_score", "first_score") == [("N", 4.0, 20.0), ("Y", 1.0, 20.0)]


@pytest.mark.parametrize("first, final, flag", [(20.0, 9.0, 1), (20.0, 12.0, 1), (20.0, 13.0, 0), (0.0, 12.0, 0), (None, 12.0, 0), (None, 9.0, 1)])
def test_improved(frame, first, final, flag):
    df = frame("a double, b double", (first, final))
    assert rows(df.select(episodes.improved(F.col("a"), F.col("b")))) == [(flag,)]


def test_duplicate_episodes_count_once(frame):
    d = days(frame, ("2024-01-01", "s"), ("2024-02-01", "e"), ("2024-06-01", "e"), ("2024-06-10", "v"), ("2024-06-15", "e"))
    ep = episodes.build(episodes.pair(d, KEYS), KEYS)
    st = episodes.episode_stats(ep, d, KEYS)
    assert rows(st, "start_date", "end_date", "visits") == [("2024-01-01", "2024-02-01", 1), ("2024-05-01", "2024-06-15", 1)]


def test_preferred_score(frame):
    v = frame("k int, day date, code int", (1, "2024-01-01", 5), (1, "2024-01-01", 7), (2, "2024-01-01", 1), (3, "2024-01-01", 1))
    own = frame("k int, day date, self_score double, self_owner string", (1, "2024-01-01", 3.0, "s"), (2, "2024-01-01", 4.0, "s"))
    staff = frame("k int, day date, staff_score double, staff_owner string", (1, "2024-01-01", 9.0, "t"))
    got = scores.preferred(v, own, staff, ["k", "day"], [F.desc_nulls_last("code")])
    assert rows(got, "k", "code", "score", "entered_by") == [(1, 7, 9.0, "t"), (2, 1, 4.0, "s"), (3, 1, None, None)]


def test_first_and_last_take_the_best_of_a_tied_day(frame):
    df = frame("k int, day date, s double", (1, "2024-01-01", 3.0), (1, "2024-01-01", 5.0), (1, "2024-02-01", 1.0), (1, "2024-02-01", None), (2, "2024-01-01", None))
    assert rows(scores.first_last(df, ["k"], "day", "s")) == [(1, "2024-01-01", "2024-02-01", 5.0, 1.0), (2, "2024-01-01", "2024-01-01", None, None)]


def test_discharge_split(frame):
    log = [
        (1, "2024-01-05", "DIS", 4.0), (1, "2024-01-20", "DIS", 2.0),          # discharged
        (2, "2024-01-05", "DIS", 4.0), (2, "2024-01-20", "TX", 2.0),           # activity after it
        (3, "2024-01-05", "TX", 4.0), (3, "2024-01-20", "DIS", 2.0),           # would be in both lists
        (4, "2024-01-05", "TX", 0.0),                                          # all zero
        *[(5, f"2023-10-{n:02d}", "TX", 9.0) for n in range(1, 7)],            # six days, quiet
        *[(6, f"2023-10-{n:02d}", "TX", 9.0) for n in range(1, 6)],            # five days
    ]
    df = frame("k int, day date, tx string, a double", *log)
    got = scores.discharge_split(df, "k", "day", F.col("tx") == "DIS", ["a"], dates.day("2024-02-10"))
    assert rows(got, "k", "session_days", "follow_up", "lost", "month") == [
        (1, 2, None, "No", "2024-01-01"), (2, 1, "2024-04-19", "Not Yet", "2024-05-01"),
        (5, 6, "2024-01-04", "Yes", "2024-02-01"), (6, 5, "2024-01-03", "Not Yet", "2024-02-01"),
    ]
