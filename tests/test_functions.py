"""Scalar functions against documented values."""

from lexmill.functions import bylines, classify, issues, numerals, text
from pyspark.sql import functions as F


def test_numerals(column):
    assert column(["十九", "二十六", "十", "二十", "一九", "七八", "１２", "百", "廿", "零", "", None], numerals.small_numeral) == [19, 26, 10, 20, 9, 8, 12] + [None] * 5
    assert column(["廿", "一四一", "一百三十三", "一百零五", "廿三", "２３", "七八", "45", "九十九"], numerals.wide_numeral) == [20, 141, 133, 100, None, 23, None, 45, 99]


def test_bylines(column):
    raw = ["——十九年一月在閩南佛學院編述——", "——民國四年春作於普陀——", "——宣統二年作——", "——三十三年春在漢藏教理院——", "（碧松記）", "見海刊九卷九期", "", None, "民國廿年作"]
    want = ["（1930 年 1 月，在閩南佛學院編述）", "（1915 年春，作於普陀）", "（1910 年，作）", "（1944 年春，在漢藏教理院）", "（碧松記）", "", "", "", "（民國廿年作）"]
    assert column(raw, bylines.normalize_byline) == want
    got = [tuple(r) for r in column(["（1930 年 1 月，在閩南佛學院編述）", "（1915 年春，作於普陀）", "（1910 年，作）", ""], bylines.byline_fields)]
    assert got == [("1930", "01", "", "閩南佛學院", "編述"), ("1915", "03", "", "普陀", "作"), ("1910", "", "", "", "作"), ("",) * 5]


def test_headings(column):
    raw = ["一緒言", "第一章釋尊略傳", "二三法印", "甲一序分", "甲色蘊", "十一結論", "百法明門論", "１十善業", "第一章"]
    want = ["一　緒言", "第一章　釋尊略傳", "二　三法印", "甲一　序分", "甲　色蘊", "十　一結論", "百　法明門論", "１十善業", "第一章"]
    assert column(raw, text.space_heading) == want
    label = lambda parent: lambda x: text.semantic_label(x, F.lit(parent))
    assert column(["第一章　緒言", "一　緒言", "甲一　序分", "子　x", "緒論"], label("章")) == ["章", "節", "節", "小小節", "節"]


def test_labels_and_snippets(column):
    assert column(["因緣（因緣生法）", "經典講釋"], text.normal_label) == ["因緣", "经典講释"]
    long = "a" * 100
    assert column([long], lambda x: text.snippet(x, F.lit(50))) == ["…" + "a" * 82 + "…"]
    assert column(["短"], lambda x: text.snippet(x, F.lit(0))) == ["短"]
    assert column(["佛學abc𠀀"], lambda x: text.count_class(x, text.CJK_WIDE)) == [3]
    assert column(["5000", "5001", "30000", "30001"], lambda x: text.bucket(x.cast("int"))) == ["5-8", "8-12", "10-15", "12-18"]


def test_issues(column):
    pairs = lambda f, t: [tuple(p) for p in column([t], f)[0]]
    assert pairs(issues.volume_issues, "二卷三至五期") == [(2, "3"), (2, "4"), (2, "5")]
    assert pairs(issues.volume_issues, "二卷十一期至三卷五期") == [(2, "11"), (2, "12")] + [(3, str(i)) for i in range(1, 6)]
    assert pairs(issues.volume_issues, "四卷七八期") == [(4, "7"), (4, "8"), (4, "7-8"), (None, "7"), (None, "8")]
    cells = column(["1卷1期", "8卷4-5期", "8卷11-2期", "1期", "六卷3-4期（合刊）", "一卷11期至三卷5期"], issues.issue_cell)
    assert [tuple(c) for c in cells] == [(1, 1), (8, 4), (8, 11), (None, 1), (6, 3), (1, 11)]
    names = {"海潮音月刊": "海潮音", "海刊": "海潮音", "正信": "正信", "覺社叢書": "覺社叢書"}
    got = column(["原見海潮音月刊十八卷十一期", "見海刊九卷第九及十期", "散見正信二卷十一期至三卷五期", "見覺社叢書第一期", "上海佛學書局印行", "無"], lambda x: issues.parse_reference(x, names))
    assert [tuple(g) for g in got] == [("海潮音", 18, [11]), ("海潮音", 9, [9, 10]), ("正信", 2, [11]), ("覺社叢書", None, [1]), ("上海佛學書局", None, None), (None, None, None)]


def test_classifier(column):
    got = column(["見海刊九卷", "——十九年在某處講——", "（碧松記）", "佛學書局印行", "民國八年", "見海刊，佛學書局印行", "", None, "xyz"], classify.classify_byline)
    assert got == ["刊载出处", "讲演信息", "记録者", "印行信息", "作者署名", "综合", "空", "空", "其他"]


def test_steps_of_a_reference_are_evaluated_once(spark):
    """Each step is bound: the text's own clean-up stands once, however many names and rules there are."""
    names = {f"名{i}": f"刊{i % 7}" for i in range(40)}
    plan = spark.range(1).select(F.lit("見名7三卷").alias("x"), F.col("id")).select(issues.parse_reference(F.concat("x", F.col("id").cast("string")), names).alias("r"))
    shown = plan._jdf.queryExecution().analyzed().toString()
    assert shown.count("散]?[見见]") == 1
    assert tuple(plan.first().r) == ("刊0", 3, None)
