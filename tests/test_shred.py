import json
import random

from folioforge.operators.shred import LAYERS, PAGE_KEYS, page_tables, shred, span_places


def brute(rows):
    """The span places by plain recursion."""
    out = set()
    for pid, text in rows:
        try:
            root = json.loads(text) if text else None
        except ValueError:
            continue
        pages = root if isinstance(root, list) else next((root[k] for k in PAGE_KEYS if k in root), None) if isinstance(root, dict) else None
        for p, page in enumerate(pages or []):
            page = page if isinstance(page, dict) else None
            for layer in LAYERS:
                for b, block in enumerate((page or {}).get(layer) or []):
                    owners = [(-1, block)] + list(enumerate((block or {}).get("blocks") or []))
                    for c, owner in owners:
                        for n, line in enumerate((owner or {}).get("lines") or []):
                            for s, span in enumerate((line or {}).get("spans") or []):
                                if isinstance(span, dict):
                                    out.add((pid, p, layer, b, c, n, s))
    return out


def tree(rng):
    span = lambda: rng.choice([None, {"type": "text", "content": rng.choice(["x", "", None]), "bbox": [1, 2.5]}, {}])
    line = lambda: rng.choice([None, {"spans": None}, {"spans": [span() for _ in range(rng.randrange(4))]}, {}])
    block = lambda depth: rng.choice([None, {"type": "text", "lines": [line() for _ in range(rng.randrange(3))], **({"blocks": [block(0) for _ in range(2)]} if depth and rng.random() < 0.5 else {})}])
    page = lambda: rng.choice([None, {rng.choice(LAYERS): [block(1) for _ in range(rng.randrange(4))], "page_idx": 0, LAYERS[0]: None}])
    pages = [page() for _ in range(rng.randrange(4))]
    return pages if rng.random() < 0.3 else {rng.choice(PAGE_KEYS): pages, "_backend": "x"}


def test_places_match_recursion(spark):
    rng = random.Random(5)
    rows = [(i, json.dumps(tree(rng))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, rows[0][1][:-1]), (203, "3"), (204, '"x"'), (205, "[NaN]"), rows[3], rows[4], (None, "[]")]
    df = spark.createDataFrame(rows, "parse_id bigint, middle_json string").withColumn("doc", __import__("pyspark").sql.functions.lit("clash"))
    got = [tuple(r) for r in span_places(shred(df, "parse_id", "middle_json", scalars=False)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute([r for r in rows if r[0] is not None])


def test_entities_keep_links_and_scalars(spark):
    text = json.dumps({"pages": [{"page_idx": 4, "blocks": [None, {"type": "text", "bbox": [1, 2], "lines": [{"spans": [{"content": "a", "score": 0.5}, {"content": None}]}]}]}]})
    nodes = shred(spark.createDataFrame([(1, text)], "k bigint, t string"), "k", "t")
    t = page_tables(nodes, {"pages": ["page_idx"], "blocks": ["type", "bbox"], "spans": ["content", "score"]})
    page, block = t["pages"].first(), t["blocks"].first()
    assert page.page_idx == "4" and block.parent == page.node and block.ordinal == 1 and block.bbox == "[1, 2]"
    assert sorted((r.ordinal, r.content, r.score) for r in t["spans"].collect()) == [(0, "a", "0.5"), (1, None, None)]


def test_one_text_stands_for_a_key(spark):
    one, two = json.dumps({"pages": [{"blocks": [{"lines": [{"spans": [{}]}]}]}]}), json.dumps({"pages": [{"blocks": [{"lines": [{"spans": [{}, {}]}]}]}]})
    rows = spark.createDataFrame([(1, one), (1, two), (1, two), (1, None), (2, one), (2, "")], "k bigint, t string")
    assert sorted(tuple(r) for r in span_places(shred(rows, "k", "t", scalars=False)).collect()) == [(1, 0, "blocks", 0, -1, 0, 0), (1, 0, "blocks", 0, -1, 0, 1), (2, 0, "blocks", 0, -1, 0, 0)]


def test_numbers_of_objects_do_not_depend_on_what_is_left_out():
    from folioforge.operators.shred import walk

    rng = random.Random(6)
    for _ in range(60):
        t = tree(rng)
        whole = {r[:5] for r in walk(t) if r[0] % 2 == 0}
        assert {r[:5] for r in walk(t, False)} == whole
        assert {r[:5] for r in walk(t, {"spans": ["type"]}, {"spans"}) if r[0] % 2 == 0} == {r for r in whole if r[2] == "spans"}
        assert all(r[2] == "type" for r in walk(t, {"spans": ["type"]}, {"spans"}) if r[0] % 2)


def test_empty_table(spark):
    assert span_places(shred(spark.createDataFrame([], "k bigint, t string"), "k", "t", scalars=False)).count() == 0


def test_every_line_has_its_owner_in_a_block_table(spark):
    import __spark_entry__ as e

    rows = {n: e.queries()[f"p5_{n}"](spark, "/root/testdata/sf0.001").collect() for n in ("blocks", "children", "lines")}
    blocks = {(r.parse_id, r.node) for r in rows["blocks"]}
    children = {(r.parse_id, r.node) for r in rows["children"]}
    assert children and not children & blocks and {(r.parse_id, r.parent) for r in rows["children"]} <= blocks
    assert {(r.parse_id, r.parent) for r in rows["lines"]} <= blocks | children
