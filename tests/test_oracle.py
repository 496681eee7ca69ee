"""Every query with SQL gives the rows of its SQL, also when every key counts as hot."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"
ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))
SKEWED = [
    "w1_percent_change",
    "w2_volatility",
    "w5_wma",
    "w6_trima",
    "w7_momentum",
    "w10_tema",
    "w11_rsi",
    "w12_apo",
    "w14_industry_return",
    "w17_quintile",
    "w18_percent_rank",
    "w18_percent_rank_whole",
    "w19_centered_rank",
    "g6_group_quantiles",
    "g10_rank_correlation",
    "g10_rank_correlation_whole",
    "d1_chronological_split",
    "d2_fold_roles",
    "e1_label_codes",
    "n3_era_neutralization",
    "p2_series_transform",
    "q1_equity_features",
    "q3_crypto_sets",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert difference(spark, con, SF, name) is None


@pytest.mark.parametrize("name", SKEWED)
def test_matches_sql_when_keys_are_hot(spark, con, hot, name):
    hot(40)
    small = ("spark.sql.autoBroadcastJoinThreshold", "spark.tidepanel.broadcastBytes")
    for key in small:
        spark.conf.set(key, "2000")
    try:
        assert difference(spark, con, SF, name) is None
    finally:
        for key in small:
            spark.conf.unset(key)


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["ticker", "date", "week"]
    assert df.count() > 0


@pytest.mark.parametrize("missing", ["sentencepiece", "tokenizers", "zstandard", "tidepanel.llm", "corpus_pipeline"])
def test_entry_without_some_library(missing):
    """The other queries are there whatever the training-data operators lack."""
    script = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
names = entry.queries()
assert len(names) > 150 and set(entry.oracle_sql()) <= set(names) and "pipeline" not in names
assert any(n.startswith("op") for n in names) == ({missing!r} == "corpus_pipeline")
print("fine")
"""
    here = Path(entry.__file__).resolve().parent
    done = subprocess.run([sys.executable, "-c", script], cwd=here, capture_output=True, text=True, timeout=120)
    assert "fine" in done.stdout, done.stderr[-1500:]
