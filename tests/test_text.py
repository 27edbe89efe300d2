import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticeworks import model as M
from noticeworks.functions import compose as C, notice as N, status as S, text as X

AT = dt.datetime


def test_strip_matches_python(one):
    values = [f"{w}a{w}b{w}" for w in X.WHITESPACE] + ["", "   ", "​x"]
    assert one(values, X.strip) == [v.strip() for v in values]


def test_clean(one):
    given = {
        "NA": None, "N/A": None, "-": None, "": None, " ": None, "na": "na", "functional testing": None,
        "a window.open b": None, "x" * 600: "x" * 600, "x" * 601: None, " a b ": "a b", "&nbsp;": None,
    }
    assert one([*given, None], X.clean) == [*given.values(), None]


def test_amount(one):
    given = {
        "3,86,15,626": 38615626.0, "₹ 1,000": 1000.0, "0.00": 0.0, "Rs. 500": None, "1_000": None,
        "nan": None, "inf": None, "1.5d": None, "-2.5e3": -2500.0, ".5": 0.5, "5.": 5.0, "": None, "1 000": 1000.0,
    }
    assert one([*given, None], X.amount) == [*given.values(), None]


def test_first_int(one):
    given = {"120": 120, "90 Days": 90, "1,200 Days": 1, "Days": None, "": None, "99999999999": 99_999_999_999}
    assert one([*given, None], X.first_int) == [*given.values(), None]


def test_notice_date(one):
    given = {
        "26-Feb-2026 10:00 AM": AT(2026, 2, 26, 10), "6-feb-2026 9:05 pm": AT(2026, 2, 6, 21, 5),
        "26-Feb-2026 13:00": AT(2026, 2, 26, 13), "26-Feb-2026": AT(2026, 2, 26), "26/02/2026": AT(2026, 2, 26),
        "26-Feb-2026  10:00 AM": AT(2026, 2, 26, 10), " 1/3/2026 ": AT(2026, 3, 1),
        "1-Jan-2026 12:00 AM": AT(2026, 1, 1), "1-Jan-2026 12:30 PM": AT(2026, 1, 1, 12, 30),
        "26-Feb-2026 13:00 PM": None, "31-Feb-2026": None, "26-Feb-26": None, "26-Feb-2026 10:00 AM IST": None,
        "": None, "26-Xyz-2026": None, "0-Jan-2026": None, "1-Jan-0000": None, "1-Jan-2026 24:00": None,
        "1-Jan-2026 10:60": None, "26-02/2026": None, "1/Jan/2026": None, "1-Jan-2026 0:10 AM": None,
    }
    assert one([*given, None], X.notice_date) == [*given.values(), None]


def test_notice_date_agrees_with_strptime(one):
    forms = ["%d-%b-%Y %I:%M %p", "%d-%b-%Y %H:%M", "%d-%b-%Y", "%d/%m/%Y"]
    values = [
        f"{d}-{m}-{y}{t}" for d in ("1", "09", "31", "32") for m in ("Jan", "FEB", "sept", "Dec")
        for y in ("2024", "0001", "99") for t in ("", " 0:00", " 12:00 am", " 23:59", " 11:5 PM", " 7 pm")
    ] + ["29/2/2024", "29/2/2023", "2/13/2024"]

    def expected(v):
        for form in forms:
            try:
                return dt.datetime.strptime(v, form)
            except ValueError:
                continue

    assert one(values, X.notice_date) == [expected(v) for v in values]


@pytest.mark.parametrize(
    "text, title, ref",
    [
        ("[T][R][I]", "T", "R"), ("[T] [R][I]", "T", "[R"), ("[A[1] repair of road][REF][ID]", "A[1", "repair of road"),
        ("[T][R", "[T][R", ""), ("Plain title", "Plain title", ""), ("[[ T ][R ][I]", "T", "R"),
    ],
)
def test_split_title_ref(one, text, title, ref):
    assert one([text], lambda c: N.split_title_ref(c)[0]) == [title]
    assert one([text], lambda c: N.split_title_ref(c)[1]) == [ref]


def test_is_notice(one):
    given = {
        "Supply of medical kit": True, "Supply of desk chair": False, "Research laboratory equipment supply": False,
        "Road widening near old city gate bridge": True, "Laying of pipes in five": False,
        "123456789 123456789 1234": False, "Supply of pumps | lot 4 of 9": False, "A network for the district": True,
        "Tender identification of sites": True, "Check of tender identification": False,
    }
    given["Tender identification of sites"] = False  # contains "tender id"
    x = F.lit("x")
    assert one(list(given), lambda c: N.is_notice(c, x, x, x, x)) == list(given.values())
    title = "Supply of medical kit"
    for field, values in M.HEADER_FIELD_VALUES.items():
        for v in values:
            args = {f: x for f in M.HEADER_FIELD_VALUES} | {field: F.lit(v.title())}
            assert one([title], lambda c: N.is_notice(c, **args)) == [False]


def test_urls(one):
    given = {"/a?b=1": "https://eprocure.gov.in/a?b=1", "a": "https://eprocure.gov.ina", "http://x/": "http://x/", "": None}
    assert one([*given, None], X.link_url) == [*given.values(), None]


def test_unescape_decodes_once(one):
    assert one(["&amp;lt;", "a &lt; b&nbsp;&#8377;&quot;&#39;"], X.unescape) == ["&lt;", "a < b ₹\"'"]


def test_status_classes(one):
    given = {"complete": "done", "completed": "done", "error": "failed", "cancelled_by_user": "failed", "running": "running", "odd": "running"}
    assert one([*given, None], S.job_class) == [*given.values(), "running"]
    as_int = lambda f: lambda c: f(c.cast("int"))
    codes = ["200", "404", "429", "500", "301"]
    assert one(codes, as_int(S.submit_class)) == ["ok", "permanent", "retryable", "retryable", "permanent"]
    assert one(codes, as_int(S.poll_class)) == ["ok", "gone", "retryable", "retryable", "retryable"]


def test_page_flags(one):
    given = {
        '<img src="/x/captcha.png">': True, "<img src=/CAPTCHA.png>": False, "<IMG class=a ALT='My Captcha'>": True,
        "<img id=Captcha1>": True, "<img title='a' src='b'>": False, "<div id='captchaImage'>": True,
        "<p>captcha</p>": False, '<img data="captcha">': False,
    }
    assert one(list(given), S.challenge_page) == list(given.values())
    nexts = {
        "<a href=x>&gt;</a>": True, "<a> > </a>": True, "<a>&gt;&gt;</a>": False, "<a><b>&gt;</b></a>": True,
        "<abbr>&gt;</abbr>": False, "<a>next ></a>": False,
    }
    assert one(list(nexts), S.has_next_page) == list(nexts.values())
    assert one(["<p>SESSION Expired</p>", "<p>ok</p>"], S.session_expired) == [True, False]


def test_texts(spark):
    cols = [f for f, _ in M.NOTICE_TEXT_PARTS]
    rows = spark.createDataFrame(
        [("T", "", None, None, "L", None, None), (None,) * 7, ("  ",) + (None,) * 6], ", ".join(f"{c} string" for c in cols)
    )
    assert [r[0] for r in rows.select(C.notice_text()).collect()] == ["T. Location: L", None, None]
    prefs = spark.createDataFrame(
        [("u", "G", ["a", "b"], None, [], None, None, None, None), ("v",) + (None,) * 8], M.PREFERENCE_SCHEMA
    )
    assert [r[0] for r in prefs.select(C.preference_text()).collect()] == ["Goal: G. Keywords: a, b", None]
