from pyspark.sql import functions as F

from storyflow.llm import endings as E

WHOLE = ["Rain falls on the old roof.", "A dog runs along the narrow path.", "Nothing moves except a clay pot, which sways a little.", "片刻之后镜头向左摇。", "两人身后，雨水划过窗户。"]


def test_stack_automaton():
    assert E.unclosed("a [b] (c {d}) “e” «f» <b>x</b> ```y```") == []
    assert [m for m, _ in E.unclosed("a [b (c")] == ["[", "("]
    assert E.unclosed("(a [b) c") == [] and [m for m, _ in E.unclosed("„a“ „b")] == ["„"]
    assert [m for m, _ in E.unclosed("<i>x <br/> y")] == ["<i>"] and [m for m, _ in E.unclosed("```x")] == ["```"]
    assert E.unclosed("] ) }") == [] and E.unclosed("") == []


def read(text):
    return E.Endings().read(text)[0]


def test_what_needs_no_baseline():
    for t in ("It ends. He said [Long Na", "It ends. A “quote” and,", "It ends. Broken �", "It ends. x \\u4f", "It ends. [Ann]", "one [Ann"):
        assert read(t) == "cut", t
    for t in ("It ends.", "It ends.”", 'It ends."  \n', "It ends. [...]", "It ends. (fin)", "It ends! 🎬", "完。", "It ends. ♪ ♪", "It ends?" + " " * 500):
        assert read(t) == "whole", t
    for t in ("", " ", "N/A", "...", "​", "…"):
        assert read(t) == "blank", t
    assert read("It ends. And then he") == "open" == read("It ends. And then he…") == read("It ends. And then he (fin)")


def test_every_open_mark_is_evidence():
    whole = "He waits by the old door"
    for t in (
        f'It ends. [Ann] says: "{whole}', f"It ends. [Ann] says “{whole}", f"„Es regnet. {whole}", f"«Il pleut. {whole}", f"»Es regnet. {whole}", f"《雨. {whole}", f"```\nIt ends. {whole}", f"<b>It ends. {whole}", f"It ends. {whole} <i",
        f"It ends. (He goes. {whole}", f"1. {whole}\n2.", f"- {whole}\n- ", f"“It ends.\n“{whole}",
    ):
        assert read(t) == "cut", t
    for t in (
        f'It ends. "{whole}"', f"It ends. “{whole}”", f"„{whole}“", f"„{whole}”", f"«{whole}»", f"»{whole}«", f"<b>{whole}</b>", f"<b><i>It ends.</b></i> {whole}", f"It ends.<br> {whole}", f"```[```{whole}", f'A 5" nail. {whole}', f"a) It ends. {whole}",
        f"“It ends.\n“It ends.” {whole}", f"- It ends\n- {whole}", f"x < y. {whole} <3",
    ):
        assert read(t) == "open", t
    assert read("It ends.\n2.") == "whole" == read(f'He says "{whole}.')


def found(spark, texts):
    rows = [("f", "r", str(i), "s", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "field string, run_id string, item_id string, source string, text string").withColumns({"what": F.lit("x"), "n": F.lit(1)})
    return {int(r.item_id) for r in E.truncated(df).collect()}


def test_baseline_of_endings(spark):
    base = [" ".join(WHOLE)] * 3
    cut = ["Rain falls on the old roof. A dog runs along the nar", "A dog runs along the…", "Nothing moves except a clay pot [...]", "片刻之后镜头向", 'Rain falls on"', "A dog runs along the narrow path. Nothing moves except a clay pot, which sways\n"]
    whole = ["Rain falls on the old roof", "Rain falls. A dog runs along the narrow path 🎬", "Nothing moves except a felt hat, which sways a little…", "两人身后，雨水划过窗户 (fin)", None, "", "N/A", "A dog runs along the narrow path. " * 4000]
    got = found(spark, base + cut + whole)
    assert got == set(range(3, 3 + len(cut)))
    assert found(spark, []) == set()


def test_rates_count_each_value_once(spark):
    rows = [("f", "r", "1", "s", WHOLE[0]), ("f", "r", "1", "s", WHOLE[0]), ("f", "r", "2", "s", "Rain fal"), ("f", "r", "2", "s", "Rain fal"), ("f", "r", "3", None, WHOLE[1]), ("f", "r", "4", "s", " "), ("f", "r", "5", "s", "N/A")]
    df = spark.createDataFrame(rows, "field string, run_id string, item_id string, source string, text string").withColumns({"what": F.lit("x"), "hit": F.lit(1)})
    got = sorted((r.source or "", r.n_values, r.n_unended, r.n_cut, r.share) for r in E.rates(df).collect())
    assert got == [("", 1, 0, 0, 0.0), ("s", 3, 1, 1, 1 / 3)]
    assert E.rates(df.limit(0)).count() == 0


def test_an_end_that_looks_whole_is_judged_by_its_source(spark):
    """One such end among a hundred cuts is a cut before the full stop; in a source that leaves full stops out it is whole."""
    whole = "A dog runs along the narrow path"
    rows = [("f", "r", f"w{i}", "s", " ".join(WHOLE)) for i in range(3)]
    rows += [("f", "r", f"c{i}", "tidy", f"Rain falls on the old roof. A dog runs along the nar{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(100)] + [("f", "r", "c", "tidy", whole)]
    rows += [("f", "r", f"h{i}", "lazy", whole) for i in range(30)] + [("f", "r", "h", "lazy", "A dog runs along the"), ("f", "r", "n", None, whole)]
    df = spark.createDataFrame(rows, "field string, run_id string, item_id string, source string, text string")
    got = {r.item_id for r in E.truncated(df).collect()}
    assert got == {f"c{i}" for i in range(100)} | {"c", "h"}
    assert {(r.source, r.n_unended, r.n_cut) for r in E.rates(df).collect()} == {("s", 0, 0), ("tidy", 101, 101), ("lazy", 31, 1), (None, 1, 0)}
