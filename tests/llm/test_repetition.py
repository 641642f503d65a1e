import pytest
from pyspark.sql import functions as F

from storyflow.llm import repetition as R

ROW = "field string, run_id string, item_id string, source string, text string"


def test_shares():
    s = "the red fox jumps over a lazy dog"
    assert R.repeated_share(s) == 0.0
    assert R.repeated_share(f"1. {s}.\n2) {s.upper()}!") == pytest.approx(0.5)
    assert R.repeated_share(f"{s}, {s}; {s} {s}") == pytest.approx(0.75)
    assert R.repeated_share("again again again again") == pytest.approx(0.75)
    assert R.repeated_share("no no") == pytest.approx(0.5)
    assert R.repeated_share("he said that he said it") == 0.0  # a short phrase is no repetition
    assert R.repeated_share("He runs fast. He runs fast.") == pytest.approx(0.5)  # a whole sentence is
    assert R.repeated_share("Er ruht.\nEr geht.\nER RUHT!") == pytest.approx(6 / 18)
    assert R.repeated_share("Go. Stop. Go.") == 0.0  # of a single word only where it follows itself
    assert R.repeated_share("他跑。她坐。他跑。") == pytest.approx(2 / 6)
    assert R.repeated_share("雨水划过窗户，雨水划过窗户。") == pytest.approx(0.5)
    assert R.repeated_share("[Ann Lee Roe] waits. [Ann Lee Roe] sits.") == 0.0
    for t in (None, "", " ", "1 1 1 1", "one", "​"):
        assert R.repeated_share(t) == 0.0
    assert R.repeated_share(("word " * 3 + "other ") * 50_000) > 0.99


def test_thresholds_and_cases(spark):
    plain = "a quiet street with number {} and a house of colour {} near the river"
    rows = [("f", "r", f"p{i}", "s", plain.format(f"w{chr(97 + i % 26)}x", f"c{chr(97 + i // 26)}y")) for i in range(60)]
    rows += [("f", "r", "rep", "s", "the same old line of words. " * 5), ("f", "r", "rep", "s", "the same old line of words. " * 5), ("f", "r", "nul", "s", None), ("f", "r", "emp", None, ""), ("f", "r", "zh", None, "片刻之后镜头向左摇。" * 4)]
    df = spark.createDataFrame(rows, ROW).withColumns({"lang": F.lit("x"), "share": F.lit(9.0), "threshold": F.lit(0)})
    got = {(r.item_id, r.lang): (r.share, r.threshold) for r in R.repetitive(df).collect()}
    assert set(k for k, _ in got) == {"rep", "zh"} and all(0.1 <= t <= 0.3 for _, t in got.values())
    assert got["rep", "en"][0] == pytest.approx(0.8) and R.repetitive(df).count() == 2
    assert R.repetitive(df.limit(0)).count() == 0
    th = R.thresholds(R.shares(df)).where("lang = 'en'").first()
    assert th.n == 61 and th.threshold == pytest.approx(0.1)
