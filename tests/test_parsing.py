import math
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statquarry.functions import parsing as p

EDGE = ["12", " 12.5 ", "N/a", "", None, "nan", "inf", "1d", "1.5f", "1,234", "50%", "1e3", "-0.5", ".5", "5.", "0x10", "1e999"]


def test_num_takes_plain_numbers_only(column):
    assert column(EDGE, p.num) == [
        12.0, 12.5, None, None, None, None, None, None, None, None, None, 1000.0, -0.5, 0.5, 5.0, None, None,
    ]


def test_clean_num_drops_commas(column):
    assert column(["1,234", "12,345.5", "a,b"], p.clean_num) == [1234.0, 12345.5, None]


def test_safe_int(column):
    assert column(["34", "1,234", "N/a", "", None, "12.5", "x", "-7"], p.safe_int) == [34, 1234, 0, 0, 0, 0, 0, -7]
    assert column(["x"], lambda c: p.safe_int(c, 5)) == [5]
    assert column(["99999999999999999999"], p.safe_int) == [0]


def test_finite(column):
    values = [1.0, float("nan"), float("inf"), float("-inf"), None]
    assert column(values, p.finite, "double") == [1.0, None, None, None, None]


def test_null_tokens(column):
    assert column(["N/a", "n/a", "NA", "nan", "", " ", "Na", "0"], p.null_tokens) == [
        None, None, None, None, None, None, "Na", "0",
    ]


def test_strip_percent_and_space(column):
    assert column(["50%", "7", None], p.strip_percent) == ["50", "7", None]
    assert column(["\t a b \n", " x ", ""], p.strip_space) == ["a b", "x", ""]


def test_first_token(column):
    assert column(["Ada Lovelace King", "Pelé", "", None, " x"], p.first_token) == ["Ada", "Pelé", "", "", ""]


def test_name_key(column):
    names = ["Martin Ødegaard", "Łukasz Fabiański", "João Gomes ", None, "ﬁn", "İlkay"]
    assert column(names, p.name_key) == ["martin ødegaard", "łukasz fabianski", "joao gomes", "", "fin", "ilkay"]


def test_name_key_keeps_no_batch_of_long_texts(spark, capsys):
    """Texts go to Python in small lots: an Arrow batch would hold 10,000 of any length."""
    df = spark.createDataFrame([("É" * 100_000 + " ",), (None,)], "c string").select(p.name_key("c").alias("k"))
    assert {r.k for r in df.collect()} == {"e" * 100_000, ""}
    df.explain()
    plan = capsys.readouterr().out
    assert "BatchEvalPython" in plan and "Arrow" not in plan


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=40))
def test_name_key_is_nfkd_without_marks(column, texts):
    texts = [t.replace("\x00", "").encode("utf-8", "ignore").decode() for t in texts]
    expected = [
        "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower().strip() for t in texts
    ]
    assert column(texts, p.name_key) == expected


MONEY = ["€117M", "€900K", "£1,250K", "€ 5m", "500000", "N/a", "", "€1.2B", None, "$2.5m", "n/a"]


def test_money_raw(column):
    assert column(MONEY, p.money_raw) == pytest.approx([117.0, 0.9, None, 5.0, 0.5, None, None, None, None, 2.5, None])


def test_money(column):
    assert column(MONEY, p.money) == pytest.approx([117.0, 0.9, 1.25, 5.0, 0.5, None, None, None, None, 2.5, None])
    assert column(["€2.675m", "€0.125m", "€0.375m", "1,255k", "€1.005m"], p.money) == [
        round(2.675, 2), round(0.125, 2), round(0.375, 2), round(1.255, 2), round(1.005, 2),
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**9, 10**9).map(lambda n: n / 1000), min_size=1, max_size=200))
def test_round_binary_is_exact(column, values):
    assert column(values, p.round_binary, "double") == [round(v, 2) for v in values]


def test_score_and_age(column):
    assert column(["92.8", "92.8/100", "N/a", "", "x/100"], p.score) == [92.8, 92.8, None, None, None]
    assert column(["24-123", "31", "N/a", None], p.age_years) == [24.0, 31.0, None, None]


def test_nan_to_num_and_clamp(column):
    big = float.fromhex("0x1.fffffffffffffp+1023")
    values = [1.5, float("nan"), float("inf"), float("-inf"), None]
    assert column(values, p.nan_to_num, "double") == [1.5, 0.0, big, -big, 0.0]
    assert column([-1.0, 0.0, 2.0], p.clamp_zero, "double") == [0.0, 0.0, 2.0]


def test_texts(column):
    assert column([1.0, 2.346, None], p.fixed, "double") == ["1.00", "2.35", None]
    assert column(["A (1.00)", "N/A"], p.leader_group) == ["A", "N/A"]


def test_slugs(column):
    names = ["Shooting: Standard: SoT%", "Passing: Expected: 1/3", 'a<b>*?"|', "Per 90 minutes: xG", "x" * 150]
    assert column(names, p.metric_slug) == [
        "Shooting_Standard_SoTPercent", "Passing_Expected_1_3", "ab", "Per_90_minutes_xG", "x" * 100,
    ]
    assert column(["Goals: A/B"], p.metric_slug_plain) == ["Goals_AB"]
    assert not any(math.isnan(v) for v in [0.0])
