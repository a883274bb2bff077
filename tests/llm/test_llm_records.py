"""Operators on records: survivorship and catalogue mapping."""

from datetime import datetime

import pytest

pytest.importorskip("folioforge.llm")

from folioforge.llm import catalog, survivor  # noqa: E402

T = [datetime(2024, 1, d) for d in range(1, 9)]
PINS = "pin_id bigint, document_name string, pkg string, pin_no string, pin_name string, type string, description string, extractor string, extracted_at timestamp, name int"


def rows():
    return [
        (1, "d", "P", "A4", "SPI_CLK_7", "P", "Programmable current limit", "rule", T[0], 0), (2, "d", "P", " a4", "spi clk 7", None, "Programmable…", "manual", T[1], 0), (3, "d", "P", "Pin A4", None, "", None, "ocr", T[2], 0),
        (4, "d", "P", "", "SPI_CLK_7*", "p", "", "office", T[3], 0), (5, "d", "P", "A4", "KEYPAD_ROW", "I", "x", "vlm", T[4], 0), (6, "d", "Q", "A4", "SPI_CLK_7", "O", "y", "rule", T[5], 0), (7, "d", "P", "B1", "PGND", "G", None, "rule", T[5], 0),
        (8, "d", "P", "B2", "PGND(1)", "G", None, "rule", T[5], 0), (9, "d", "P", None, "PGND", "G", None, "rule", T[5], 0), (10, "d", "P", None, None, None, None, None, None, 0), (1, "d", "P", "A4", "SPI_CLK_7", "P", "Programmable current limit", "rule", T[0], 0),
        (11, "d", "P", "#03.", "GPI0__8", "I", "z", "rule", T[0], 0), (12, "d", "P", "３", "GPIO 8", "I", "z", "rule", T[0], 0),
    ]


def test_pairs(spark):
    df = spark.createDataFrame(rows(), PINS)
    # record 3 has number A4 only, which two pins have; 9 has a name that two pins have
    assert sorted(tuple(r) for r in survivor.duplicate_pairs(df).collect()) == [(1, 2), (1, 4), (2, 4), (11, 12)]
    assert survivor.duplicate_pairs(df.limit(0)).count() == 0


def test_survivor_takes_each_field_from_the_best_record(spark):
    df = spark.createDataFrame(rows(), PINS)
    kept = {r.pin_id: r for r in survivor.survivors(df).collect()}
    best = kept[1]
    assert (best.records, best.pin_no, best.description, best.type) == (3, " a4", "Programmable current limit", "p")
    assert sum(r.records for r in kept.values()) == 12 and kept[10].pin_no is None
    assert {tuple(r) for r in survivor.survivors(df.orderBy("pin_id", ascending=False)).select("pin_id", "pin_no", "pin_name").collect()} == {(r.pin_id, r.pin_no, r.pin_name) for r in kept.values()}


ENTRIES = [(1, "TSSOP", "KJV", "4"), (2, "TSSOP", "TKK", "5"), (3, "SOIC", "KTR", "4"), (4, "X2DFN", "WZG", "4"), (5, "CDIP", "YDR", "16"), (6, "FCCSP", "YWG", "16"), (7, "VQFN", "DDF", "16")]


@pytest.fixture(scope="module")
def mapped(spark):
    values = [
        "TSSOP-4 (KJV)", "tssop 4", "TSSOP5", "KJV", "T5S0P-4 KJV", "50IC-4 KTR", "TSOSP TKK 5", "4L SOIC", "ＳＯＩＣ－４", "4引脚 SOIC 封装", "X2DFN4", "X22DFN-4 (WZG)", "TSSOP", "4-pin", "TSSOP-9", "QUADPAK 4", "see addendum", "-", "TBD", None, "",
        "16-ball/lead flip-chip scale YWG", "CDDIP 16", "TSSOP-4 (KJV) tape & reel", "TSSOP-5 (KJV)",
    ]
    rows = [(i, v, 3) for i, v in enumerate(values)] + [(0, values[0], 3)]
    df = spark.createDataFrame(rows, "assignment_id bigint, pkg string, value int")
    entries = spark.createDataFrame(ENTRIES, "entry_id bigint, package_type string, package_drawing string, pin_count string")
    got = {r.assignment_id: r.entry_id for r in catalog.map_to_catalog(df, entries).collect()}
    assert catalog.map_to_catalog(df.limit(0), entries).count() == 0
    return {v: got.get(i) for i, v in enumerate(values)}


@pytest.mark.parametrize(
    ("value", "entry"),
    [
        ("TSSOP-4 (KJV)", 1), ("tssop 4", 1), ("TSSOP5", 2), ("KJV", 1), ("T5S0P-4 KJV", 1), ("50IC-4 KTR", 3), ("TSOSP TKK 5", 2), ("4L SOIC", 3), ("ＳＯＩＣ－４", 3), ("4引脚 SOIC 封装", 3), ("X2DFN4", 4), ("X22DFN-4 (WZG)", 4), ("TSSOP", -1), ("4-pin", -1),
        ("TSSOP-9", -1), ("QUADPAK 4", -1), ("see addendum", -1), ("-", -1), ("TBD", -1), (None, None), ("", None), ("16-ball/lead flip-chip scale YWG", 6), ("CDDIP 16", 5), ("TSSOP-4 (KJV) tape & reel", 1), ("TSSOP-5 (KJV)", -1),
    ],
)
def test_catalogue(mapped, value, entry):
    assert mapped[value] == entry
