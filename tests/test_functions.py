import pytest
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.functions import ranges
from folioforge.functions import text as tx


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("1-5", "1 2 3 4 5"), ("1 - 5", "1 2 3 4 5"), ("1 -5", "1 2 3 4 5"), ("01-03", "01 02 03"), ("5-1", "5-1"), ("1-1002", "1-1002"), ("A1-C3", "A1-C3"), ("A1-A5", "A1 A2 A3 A4 A5"), ("L[7:12]", "L7 L8 L9 L10 L11 L12"),
        ("5-5", "5"), ("1-03", "01 02 03"), ("1-1001", " ".join(map(str, range(1, 1002)))), ("A5-A5", "A5"), ("3000000000-3000000002", "3000000000 3000000001 3000000002"), ("99999999999999999999-99999999999999999999", "99999999999999999999-99999999999999999999"),
        ("N/A", "N/A"), ("A1, A2", "A1 A2"), ("", ""), (None, ""),
    ],
)
def test_pin_numbers(spark, cell, want):
    assert one(spark, ranges.split_and_expand(F.col("c")), c=cell) == want.split()


@pytest.mark.parametrize(("cell", "want"), [("GPIO[0:2]_A", ["GPIO0_A", "GPIO1_A", "GPIO2_A"]), ("LED[2:0]", ["LED2", "LED1", "LED0"]), ("BUS[1:0]_LANE[1:0]", None)])
def test_bracket_ranges(spark, cell, want):
    assert one(spark, ranges.expand_bracketed(F.col("c")), c=cell) == want


@pytest.mark.parametrize(
    ("function", "given", "want"),
    [
        (tx.plain_text, " a<br/>b &amp; <b>c</b>\n d ", "a b & c d"), (tx.cell_text, "a<br> <br>b", "a\nb"), (tx.header_form, "Pin_No. [1]*", "pin no."), (tx.strip_footnotes, "Name (1, 2)", "Name"), (tx.clean_name, "VDD(1)", "VDD"),
        (tx.clean_name, " ", "Reserved"), (tx.clean_name, None, "Reserved"), (tx.markdown_escape, "a_b\\_c", "a\\_b\\_c"), (tx.margin_form, " — Rev. A | ", "rev. a"), (tx.heading_level, "## x", 2), (tx.heading_level, "1.2.3 Title", 3), (tx.heading_level, "第3章", 1),
        (tx.heading_level, "plain", None), (tx.glued_parts, "D11B10", ["D11", "B10"]), (tx.glued_parts, "D11", ["D11"]), (tx.slot_name, 27, "ab"), (tx.slot_name, 702, "aaa"), (tx.cjk_language, "", None), (tx.cjk_language, "中文 x", "zh"), (tx.package_pins, "8-pin PW", "8"),
        (tx.unligature, "eﬃcient", "efficient"), (tx.inline_math, "x <eq>a</eq>", "x $a$"), (tx.undo_confusion, "GPI0X", "GPIOX"),
    ],
)
def test_text_functions(spark, function, given, want):
    assert one(spark, function(F.col("c")), c=given) == want


@pytest.mark.parametrize(("text", "name", "want"), [("the QFN-16 part", "qfn", True), ("the XQFN part", "qfn", False), ("x", "", False)])
def test_named_in(spark, text, name, want):
    assert one(spark, tx.named_in(F.col("t"), F.col("n")), t=text, n=name) is want


def test_boxes(spark):
    row = spark.createDataFrame([([0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 3.0, 3.0], [5.0, 6.0, 7.0, 8.0])], "a array<double>, b array<double>, c array<double>")
    a, b, c = (geo.Box.of(F.col(x)) for x in "abc")
    got = row.select(geo.iou(a, b), geo.overlap_of_first(a, b), geo.edge_distance(a, c), geo.position(a, c), geo.contains(a, b), geo.iou(a, c)).first()
    assert got[0] == pytest.approx(1 / 7) and got[1] == 0.25 and got[2] == 5.0 and got[3] == "left-top" and got[4] is False and got[5] == 0.0
