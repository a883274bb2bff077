import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import ranges
from folioforge.operators.packed import NAME, SEPARATORS, parse_cell, split_names, split_numbers, split_packed


def texts(items):
    return [i.text for i in items]


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("1-5", "1 2 3 4 5"), ("1 - 3", "1 2 3"), ("1 -3", "1 2 3"), ("1- 3", "1 2 3"), ("01-03", "01 02 03"), ("5-1", "5-1"), ("1-1002", "1-1002"),
        ("A1-C3", "A1-C3"), ("A1-A5", "A1 A2 A3 A4 A5"), ("L[7:12]", "L7 L8 L9 L10 L11 L12"), ("L[12:7]", "L[12:7]"), ("A1, A2", "A1 A2"), ("M9 和 E8", "M9 E8"),
        ("M11, C3 and G12", "M11 C3 G12"), ("12 | 15,16;17", "12 15 16 17"), ('"4" "8"', "4 8"), ("'85';'87'", "85 87"), ("F6,,H12", "F6 H12"), ("94<br/>96<BR>97", "94 96 97"),
        ("8\t15", "8 15"), ("11/18", "11 18"), ("20–21", "20 21"), ("6~7", "6 7"), (" ,; ", ""), ("80，81，", "80 81"),
    ],
)
def test_numbers(cell, want):
    assert texts(split_numbers(cell)) == want.split()


def test_numbers_without_value():
    assert split_numbers(None) == split_numbers("  ") == []


@pytest.mark.parametrize(
    ("cell", "pins", "want"),
    [
        ("GPIO[0:2]_A", 3, ["GPIO0_A", "GPIO1_A", "GPIO2_A"]), ("LED[4:0]_3", 5, ["LED4_3", "LED3_3", "LED2_3", "LED1_3", "LED0_3"]), ("OUT[3:0]; CS_B", 5, ["OUT3", "OUT2", "OUT1", "OUT0", "CS_B"]),
        ("PA7/VSS0<br>PB8/VSS1", 2, ["PA7/VSS0", "PB8/VSS1"]), ("AVDD/VREF", 4, ["AVDD/VREF"]), ("A / B", 2, ["A", "B"]), ("'SEL,2' 'SEL,3'", 2, ["SEL,2", "SEL,3"]), ("A,B,C", 2, ["A,B,C"]),
        ("MOSI, AUX4", 0, ["MOSI", "AUX4"]), ("PC0/ADDR5", 0, ["PC0/ADDR5"]), ("EP (thermal pad)", 0, ["EP (thermal pad)"]), ("DQ[6]", 1, ["DQ[6]"]), ("VDD_CORE PWM5", 2, ["VDD_CORE", "PWM5"]),
    ],
)
def test_names(cell, pins, want):
    assert texts(split_names(cell, pins)) == want


def test_unclosed_quote_goes_back_to_a_bare_value():
    items = parse_cell('"A1, B2"x, "C3"', SEPARATORS["comma"], NAME)
    assert [(i.text, i.kind, i.error) for i in items] == [("A1", "bare", "unbalanced_quote"), ('B2"x', "bare", None), ("C3", "quoted", None)]


@given(st.text(alphabet="A1,;/|&[]:-\"' \n<br>和", max_size=30))
def test_any_text_is_read_to_its_end(cell):
    items = split_numbers(cell)
    assert all(0 <= i.start < i.stop <= len(cell) and i.text for i in items)


def test_long_cell():
    assert len(split_numbers(",".join(map(str, range(50_000))))) == 50_000


def test_table(spark):
    rows = [(1, "1,2", "A;B", 9), (1, "1,2", "A;B", 9), (2, None, "X,Y", 9), (3, "4", "P/Q", 9), (4, "5-7", "", 9), (None, "1,2", None, 9)]
    df = spark.createDataFrame(rows, "row_id bigint, pin_no string, pin_name string, key int")
    got = sorted((r.row_id, r.field_name, r.item_no, r.item_text) for r in split_packed(df).collect())
    assert got == [
        (1, "pin_name", 1, "A"), (1, "pin_name", 2, "B"), (1, "pin_no", 1, "1"), (1, "pin_no", 2, "2"), (2, "pin_name", 1, "X"), (2, "pin_name", 2, "Y"),
        (4, "pin_no", 1, "5"), (4, "pin_no", 2, "6"), (4, "pin_no", 3, "7"),
    ]
    assert split_packed(df.limit(0)).count() == 0


def test_ranges_reach_as_far_as_they_may(spark):
    assert texts(split_numbers("1-1001")) == [str(n) for n in range(1, 1002)]
    cells = spark.createDataFrame([("1-1001", "DATA[1000:0]")], "a string, b string")
    row = cells.select(ranges.split_and_expand(F.col("a")).alias("a"), ranges.split_and_expand(F.col("b")).alias("b")).first()
    assert row.a == [str(n) for n in range(1, 1002)] and row.b == [f"DATA{n}" for n in range(1000, -1, -1)]


def test_bracket_ranges_stand_for_all_their_values(spark):
    assert texts(split_names("DATA[1155:0]", 1156)) == [f"DATA{n}" for n in range(1155, -1, -1)]
    df = spark.createDataFrame([(1, "1-1000, 1001-1156", "DATA[1155:0]"), (2, None, "A[0:24999]")], "row_id bigint, pin_no string, pin_name string")
    got = {(r.row_id, r.field_name): (r["n"], r["last"]) for r in split_packed(df).groupBy("row_id", "field_name").agg(F.count("*").alias("n"), F.max_by("item_text", "item_no").alias("last")).collect()}
    assert got == {(1, "pin_no"): (1156, "1156"), (1, "pin_name"): (1156, "DATA0"), (2, "pin_name"): (25000, "A24999")}
