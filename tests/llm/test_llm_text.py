"""Operators on text: look-alikes, scan noise, tokenizer, leaks, personal data."""

import random
import re

import pytest

pytest.importorskip("folioforge.llm")

from folioforge.llm import bpe, canon, leak, pii, scanfix  # noqa: E402
from folioforge.llm.queries import BPE_FILE  # noqa: E402

# ---- look-alikes


@pytest.mark.parametrize(
    ("a", "b"),
    [("ＣＯＭＰ", "COMP"), ("Übеr", "Über"), ("Ü", "Ü"), ("ﬁlm", "film"), ("87.3 kΩ", "87.3 kΩ"), ("ВOОT", "BOOT"), ("Ⅵ", "VI"), ("⼯作", "工作"), ("a​b", "ab"), ("a\xa0b", "a b"), ("x‑y", "x-y"), ("µF", "μF"), ("ᎪᏴ", "AB"), ("ՕՍ", "OU"), ("ɡɑte", "gate")],
)
def test_same_print(a, b):
    assert canon.skeleton(a) == canon.skeleton(b)


@pytest.mark.parametrize(("a", "b"), [("2²", "22"), ("Große", "Größe"), ("film", "Film"), ("O", "0"), ("l", "1"), ("rn", "m"), ("é", "e"), ("ß", "ss")])
def test_other_print(a, b):
    assert canon.skeleton(a) != canon.skeleton(b)


def test_trie_takes_the_plain_then_the_frequent_spelling_and_counts_edits():
    trie = canon.Trie()
    for word, n in (("BOOT", 1), ("ВООТ", 9), ("µF", 3), ("μF", 2), ("film", 5)):
        trie.add(word, n)
    assert trie.search("B​OОT") == (0, "BOOT")
    assert trie.search("μF") == (0, "µF")
    assert trie.search("ﬁlm") == (0, "film")
    assert trie.search("firm") is None and trie.search("fiIm", 1) == (1, "film")


def test_look_alike_pairs(spark):
    rows = [
        (1, "d", 0, "BOOT 1", 7), (2, "d", 0, "ВOОT 1", 7), (2, "d", 0, "ВOОT 1", 7), (3, "d", 0, "BOOT 1", 7), (4, "d", 1, "BOOT 1", 7), (5, "e", 0, "ＢＯＯＴ 1", 7), (6, "d", 0, None, 7), (7, "d", 0, "", 7),
        (8, "d", 0, "​", 7), (9, "d", 0, "Boot 1", 7), (10, "d", 0, "BOO⁠T\xa01 ", 7), (11, None, 0, "x", 7), (12, "d", 0, "x" * 200_000, 7),
    ]
    df = spark.createDataFrame(rows, "span_id bigint, document_name string, page_idx int, content string, canon int")
    got = sorted(tuple(r) for r in canon.look_alike_pairs(df, "span_id", "content", ["document_name", "page_idx"]).collect())
    assert got == [(1, 2), (1, 10), (2, 3), (2, 10), (3, 10), (7, 8)]
    assert canon.look_alike_pairs(df.limit(0), "span_id", "content", ["document_name", "page_idx"]).count() == 0


def test_canonical_form_is_one_per_class(spark):
    rng = random.Random(1)
    alike = {"A": "AАΑＡ", "o": "oоοｏ", "e": "eе", "K": "KКΚK"}
    rows = [(i, " ".join("".join(rng.choice(alike.get(c, c)) + rng.choice(["", "​"]) for c in rng.choice(["Ae", "Ko", "xoxo", "Kelvin"])) for _ in range(3))) for i in range(300)]
    forms = {}
    for r in canon.canonical(spark.createDataFrame(rows, "k bigint, t string"), "k", "t").collect():
        forms.setdefault(canon.skeleton(r.text), set()).add(r.canon)
    assert all(len(v) == 1 for v in forms.values())


# ---- scanned pages


READER = scanfix.Reader(frozenset("the settling time below amplifier overshoot maximum clock keep out low impedance feedback board output can".split()), frozenset(["keep-out", "low-impedance", "lot-to-lot"]))


@pytest.mark.parametrize(("seen", "meant"), [("oversboot", "overshoot"), ("rnaximiim", "maximum"), ("feeclback", "feedback"), ("c|ock", "clock"), ("B0ard", "board"), ("be|ow", "below"), ("overshoot", None), ("E5", None), ("qqq", None), ("ALR00035A", None)])
def test_misread_words(seen, meant):
    assert READER.meant(seen) == meant


@pytest.mark.parametrize(("head", "tail", "noise"), [("sett", "ling", True), ("keep", "out", False), ("low", "impedance", False), ("low", "irnpedance", False), ("Lot", "to-lot", False), ("ampli", "fier", True), ("over", "sboot", True)])
def test_broken_words(head, tail, noise):
    assert READER.broken(head, tail) is noise


@pytest.mark.parametrize(("text", "wrong"), [("12", False), ("l2", True), ("- I0 -", True), ("iv", False), ("Page 3 of I1", True), ("第 l 页", True), ("Page 3 of 11", False), ("[4]", False), ("1/8", False)])
def test_page_numbers(text, wrong):
    assert scanfix.PAGE_NO.fullmatch(text) and scanfix.wrong_number(text) is wrong


def page(doc, number, body, base, footer=True):
    top = [("title", 0, f"ABC{doc} Gate Driver", 30.0)]
    lines = [("text", 1 + i, t, 70.0 + 14 * i) for i, t in enumerate(body)]
    end = [("text", 90, "Acme Logic confidential", 755.0), ("text", 91, f"- {number + 1} -", 770.0)] if footer else []
    return [(base + i, f"doc{doc}", number, [612.0, 792.0], b, kind, 0, 0, [50.0, y, 300.0, y + 11], t) for i, (kind, b, t, y) in enumerate(top + lines + end)]


def test_noise_of_spans_and_tables(spark):
    schema = "span_id bigint, document_name string, page_idx int, page_size array<double>, block_seq int, block_type string, line_seq int, span_seq int, bbox array<double>, content string"
    words = ["the settling time of the amplifier stays below the maximum overshoot"] * 9
    rows, n = [], 0
    for doc in range(1, 9):
        for p in range(4):
            body = [*words, "keep the board out of the keep-out area"]
            if doc == 1 and p == 0:
                body += ["the oversboot is low", "the sett-", "ling time", "a keep-", "out area and the ampli\xad"]
            if doc == 1 and p == 1:
                body = ["fier stays below", *body]
            rows += page(doc, p, body, n)
            n += 100
    rows += [rows[0], (n, "doc1", 0, None, 50, "text", 0, 0, None, None), (n + 1, None, None, None, 50, "text", 0, 0, None, "87")]
    tables = [
        (1, "<table><tr><td>Pin</td><td>Type</td></tr><tr><td>1</td><td>l/O</td></tr></table>"), (2, "<table><tr><td colspan='2'>Acme Logic confidential</td></tr><tr><td>the sett-<br>ling time</td><td>keep-<br>out</td></tr></table>"),
        (3, "<table><tr><td>- 4 -</td><td></td></tr><tr><td colspan='2'>Power pins</td></tr></table>"), (3, "<table><tr><td>- 4 -</td><td></td></tr><tr><td colspan='2'>Power pins</td></tr></table>"), (4, None), (5, ""), (6, "<table><tr><td>the overshoot"),
    ]
    out = scanfix.find_noise(spark.createDataFrame(rows, schema), spark.createDataFrame(tables, "table_id bigint, html string"))
    got = {tuple(r) for r in out.collect()}
    text = {r[0]: r[9] for r in rows}
    want = set()
    for id_, t in text.items():
        if t is None or id_ > n:
            continue
        if t.startswith("ABC") or t.startswith("Acme"):
            want.add(("span", id_, "running"))
        if re.fullmatch(r"- \d -", t):
            want.add(("span", id_, "page_no"))
        if "oversboot" in t:
            want.add(("span", id_, "misread"))
        if t in ("the sett-", "out area and the ampli\xad"):
            want.add(("span", id_, "hyphen"))
    want |= {("table", 1, "misread"), ("table", 2, "running"), ("table", 2, "hyphen"), ("table", 3, "page_no")}
    assert got == want
    assert scanfix.find_noise(spark.createDataFrame([], schema), spark.createDataFrame([], "table_id bigint, html string")).count() == 0


def test_words_over_pages_rare_words_and_clean_tables(spark):
    schema = "span_id bigint, document_name string, page_idx int, page_size array<double>, block_seq int, block_type string, line_seq int, span_seq int, bbox array<double>, content string"
    words = ["the settling time of the amplifier stays below the maximum overshoot."] * 9
    rows, n = [], 0
    for doc in range(1, 9):
        for p in range(4):
            body = [*words]
            if doc == 1 and p == 0:
                body += ["it holds the ampli-"]
            if doc == 1 and p == 1:
                body = []
            if doc == 1 and p == 2:
                body = ["fier stays below and runs", *words, "the time of the"]
            if doc == 1 and p == 3:
                body = ["settling is low.", *words]
            rows += page(doc, p if p < 2 or doc > 1 else p + 700, body, n)
            n += 100
    texts = scanfix.paragraphs(spark.createDataFrame(rows, schema), spark.createDataFrame([], "table_id bigint, html string"))
    got = [r.text for r in texts.where("document_name = 'doc1'").collect()]
    assert "it holds the amplifier stays below and runs" in got and "the time of the settling is low." in got
    assert not [t for t in got if "Acme" in t or t.startswith("-")]
    noise = scanfix.find_noise(spark.createDataFrame(rows, schema), spark.createDataFrame([], "table_id bigint, html string"))
    assert {r.origin_id for r in noise.where("noise = 'hyphen'").collect()} == {r[0] for r in rows if r[9] == "it holds the ampli-"}
    tables = [(1, "<table><tr><td>- 4 -</td><td></td></tr><tr><td>the sett-<br>ling rnaximum</td><td>l/O</td></tr><tr><td colspan='2'>Acme Logic confidential</td></tr></table>"), (2, None)]
    clean = scanfix.clean_tables(spark.createDataFrame(rows, schema), spark.createDataFrame(tables, "table_id bigint, html string")).collect()
    assert [tuple(r) for r in clean] == [(1, "<table><tr><td>the settling maximum</td><td>I/O</td></tr></table>")]


def test_rare_words_are_decided_by_their_counts(spark):
    counts = spark.createDataFrame([("quokka", 400), ("quakko", 2), ("quokko", 300), ("zebra", 3), ("zehra", 1), ("the", 10**6)], "token string, n bigint")
    got = {tuple(r) for r in scanfix.rare_misreads(counts, frozenset(["the"])).collect()}
    assert got == {("quakko", "quokko")}  # quokka and quokko are too near in frequency
    more = spark.createDataFrame([("wombat", 400), ("wombot", 2), ("wombet", 9)], "token string, n bigint")
    assert {tuple(r) for r in scanfix.rare_misreads(more, frozenset(["the"])).collect()} == {("wombot", "wombat")}


def test_labels_side_by_side_are_labels_one_by_one():
    model, rng = scanfix.Model(), random.Random(2)
    pages = [scanfix.np.array([rng.randrange(scanfix.PLACES * scanfix.KINDS * 2) for _ in range(rng.randrange(1, 40))]) for _ in range(50)]
    together = model.label(pages)
    assert all((a == model.label([p])[0]).all() for a, p in zip(together, pages))


def learnt_one_by_one(pages):
    """Baum-Welch as in books, over (symbols, number of pages)."""
    model, total = scanfix.Model(), sum(len(p) * n for p, n in pages)
    start, move, emit = model.start, model.move, model.emit
    prior = emit * max(100, total // 4)
    for _ in range(3):
        first, step, seen = start * 10, move * 10, prior.copy()
        for p, n in pages:
            alpha, beta = [start * emit[:, p[0]]], [scanfix.np.ones(3)]
            for c in p[1:]:
                alpha.append(alpha[-1] @ move * emit[:, c])
            for c in p[:0:-1]:
                beta.insert(0, move @ (emit[:, c] * beta[0]))
            whole = alpha[-1].sum()
            first = first + n * alpha[0] * beta[0] / whole
            for t, c in enumerate(p):
                seen[:, c] += n * alpha[t] * beta[t] / whole
                step = step + (n * alpha[t - 1][:, None] * move * emit[:, c] * beta[t] / whole if t else 0)
        start, move, emit = first / first.sum(), step / step.sum(1, keepdims=True), seen / seen.sum(1, keepdims=True)
    return start, move, emit


def test_the_model_is_fitted_on_all_pages(spark):
    kinds = [("title", "ABC Gate Driver", 0.035), ("text", "the settling time", 0.085), ("text", "第 1 2 章 of the", 0.5), ("list", "a 1", 0.6), ("table_caption", "Table 3", 0.7), ("text", None, 0.8), ("text", "Acme e\u0301", 0.955), ("text", " - l2 -\u2003", 0.975), ("text", "第 3 页", 0.975), (None, "x" * 30, None)]
    shapes = [[0, 1, 2, 3, 6, 7], [0, 2, 2, 2, 4, 8], [1, 2, 3, 9], [7, 2, 2, 6], [8], [9, 9, 9, 9, 0, 5, 2, 2, 2, 2, 2, 2, 6, 6], [6, 0, 2, 7]]
    often = [3000, 4000, 2500, 2000, 5, 1500, 1]
    schema = "shape int, at int, block_type string, content string, y double"
    rows = spark.createDataFrame([(s, i, *kinds[k]) for s, shape in enumerate(shapes) for i, k in enumerate(shape)], schema)
    pages = spark.createDataFrame([(s, n) for s, n in enumerate(often)], "shape int, n int").selectExpr("shape", "explode(sequence(1, n)) as page_idx")
    spans = pages.join(rows, "shape").selectExpr("shape * 1000000000L + page_idx * 100L + at as span_id", "if(shape = 4, null, 'doc' || shape) as document_name", "page_idx", "array(600d, 100d) as page_size", "at as block_seq", "block_type", "0 as line_seq", "0 as span_seq", "array(0d, y * 100, 9d, y * 100) as bbox", "content")
    symbol = [int(scanfix.symbols(scanfix.np.array([scanfix.np.nan if y is None else y]), scanfix.np.array([scanfix.kind_of(k)]), scanfix.np.array([int(bool(t and scanfix.is_page_number(t)))]))[0]) for k, t, y in kinds]
    known = [([symbol[k] for k in shape if kinds[k][1] is not None], n) for shape, n in zip(shapes, often)]
    assert sum(len(p) * n for p, n in known) > 60_000
    lines = scanfix.lines_of(spans.unionByName(spans.where("span_id between 1000000000 and 1000020000")))  # some delivered again
    model = scanfix.fit(lines)
    for got, want in zip((model.start, model.move, model.emit), learnt_one_by_one(known)):
        assert scanfix.np.allclose(got, want, rtol=1e-4, atol=1e-7)
    again = scanfix.fit(lines.repartition(3, "block_seq"))
    assert (again.start == model.start).all() and (again.move == model.move).all() and (again.emit == model.emit).all()


@pytest.mark.parametrize("text", ["12", "l2", "- I0 -", "iv", "Page 3 of I1", "第 l 页", "SEITE 4 VON 9", "s. 7 sur 8", "p.xlc", "3 de |S"])
def test_page_numbers_have_no_character_of_the_others(text):
    assert scanfix.is_page_number(text) and not re.search(re.sub(r"\\x\{(\w+)\}", r"\\u\1", scanfix._NO_PAGE_NO), text)


# ---- tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(BPE_FILE))


def test_encoder_is_the_merges(encoder):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(BPE_FILE.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    rng = random.Random(3)
    alphabet = "etaoin shrdlu'LLIT0123  \n\t.,-_<|>éß中文字😀‍ا"
    texts = ["", " ", "a" * 3000, "<|endoftext|>", "don't we'll  IT'S", "\r\n\r\n x"] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for t in texts:
        assert encoder.encode(t) == other.encode(t, add_special_tokens=False).ids, repr(t)
        assert "".join(bpe.decode_stream(encoder.encode(t), encoder.transducer.tokens)) == t


def test_utf8_machine_is_the_decoder():
    rng = random.Random(4)
    for _ in range(3000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0xF0, 0x90, 0xF4, 0xFF, 0xC0]) for _ in range(rng.randrange(8)))
        machine = bpe.Utf8Machine()
        assert "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.close() == data.decode("utf-8", "replace")


def test_corpus_ids(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "hello world", 5), (3, "hello world", 5)], "doc_id bigint, text string, ids int")
    rows = bpe.encode_corpus(df, BPE_FILE)
    assert rows.schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"
    assert sorted((r.doc_id, r.ids) for r in rows.collect()) == [(1, []), (2, []), (3, [31373, 995]), (3, [31373, 995])]
    assert [r.text for r in bpe.decode_corpus(rows.where("doc_id = 3").limit(1), BPE_FILE).collect()] == ["hello world"]
    assert bpe.encode_corpus(df.limit(0), BPE_FILE).count() == 0


# ---- leaks

ITEMS = [
    (1, "Suppose the operator wires a violet hygrometer across 4689 hertz while the sundial resonates near strain-gauge seven and hums"),
    (2, "黄昏之后，机库里的灯塔上那只压敏电阻读数为6289赫兹，测量员随即停机。"),
    (3, "short item text"),
    (4, None),
    (5, ""),
]


def brute(text):
    """The rule itself: consecutive words, or letters and digits."""
    out = set()
    for number, item in ITEMS:
        if not item:
            continue
        if number == 2:
            s, t = leak.stream(item), leak.stream(text)
            if any(s[i : i + 20] in t for i in range(len(s) - 19)):
                out.add(number)
        else:
            w, t = leak.words(item), leak.words(text)
            n = min(12, len(w))
            grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
            if any(tuple(t[i : i + n]) in grams for i in range(len(t) - n + 1)):
                out.add(number)
    return out


def test_leaks_match_the_rule(spark):
    rng = random.Random(5)
    filler = "lorem ipsum dolor sit amet the a while near".split()
    texts = [None, "", "  ", "SHORT **item**\ntext", "x" * 100_000 + " short item text"]
    for _ in range(400):
        _, item = ITEMS[rng.choice([0, 0, 1])]
        if item == ITEMS[1][1]:
            a, n = rng.randrange(15), rng.randrange(15, 30)
            part = item[a : a + n]
        else:
            w = item.split()
            a, n = rng.randrange(len(w)), rng.randrange(9, 16)
            part = rng.choice([" ", "\n", "  ", "** **"]).join(w[a : a + n])
            if rng.random() < 0.3:
                part = part.upper()
            if rng.random() < 0.2:
                part = part.replace("e", "ｅ")
        texts.append(" ".join(rng.choices(filler, k=5)) + " " + part + " " + " ".join(rng.choices(filler, k=5)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leak.find_leaks(docs, items).where("exact").collect()}
    assert got == {(i, n) for i, t in enumerate(texts) if t for n in brute(t)}
    assert leak.find_leaks(docs.limit(0), items).count() == 0 == leak.find_leaks(docs, items.limit(0)).count()


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ITEMS[0][1]), (2, ITEMS[1][1])], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    monkeypatch.setattr(leak, "MAX_ITEM_CHARS", 10)
    assert {(r.doc_id, r.item_id) for r in leak.find_leaks(docs, items).collect()} == {(1, 1), (2, 2)}


def test_edits_within_the_budget_are_found_by_alignment_and_short_items_whole(spark):
    rng = random.Random(7)
    w = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(40)]
    changed = [("z" + x[1:] if i % 11 == 5 else x) for i, x in enumerate(w)]
    often = [("z" + x[1:] if i % 5 == 0 else x) for i, x in enumerate(w)]
    items = spark.createDataFrame([(1, " ".join(w)), (2, "ab cd"), (3, "q"), (4, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "so " + " ".join(changed) + " end"), (2, "so " + " ".join(often)), (3, "x abcd y"), (4, "xab cdy"), (8, "x AB **cd** y"), (5, "a q a"), (6, "aqa"), (7, " ".join(w[5:19]))], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.exact) for r in leak.find_leaks(docs, items).collect()}
    assert (1, 1, False) in got and not [x for x in got if x[0] == 2 and x[1] == 1] and (7, 1, True) in got
    assert {x for x in got if x[1] == 2} == {(3, 2, True), (8, 2, True)}
    assert {x for x in got if x[1] == 3} == {(5, 3, True)}
    tables = leak.indexes([leak.Item.of(n, t, 12, 20) for n, t in enumerate([" ".join(w), "ab cd"])])
    assert sorted((t.q, t.fewest > 20) for t in tables) == [(4, False), (12, True)]


# ---- personal data


@pytest.mark.parametrize(
    ("text", "kind", "piece"),
    [
        ("write to a.b+c@mail.ex-a.test.", "email", "a.b+c@mail.ex-a.test"), ("x (at) y.org", "email", "x (at) y.org"), ("<t_u [at] lab7 [dot] example [dot] net>", "email", "t_u [at] lab7 [dot] example [dot] net"),
        ("call +1 (647) 555 0199 now", "phone", "+1 (647) 555 0199"), ("tel. 01632 960 148", "phone", "01632 960 148"), ("电话：（010）0000 4400", "phone", "（010）0000 4400"), ("unter 0049 30 23125-481.", "phone", "0049 30 23125-481"),
        ("au 01.99.00.67.53.", "phone", "01.99.00.67.53"), ("ID QQ 97 95 62 C;", "id_number", "QQ 97 95 62 C"), ("no. 981-84-8359)", "id_number", "981-84-8359"), ("号：99133519721026306X", "id_number", "99133519721026306X"),
        ("to 966 Lantern Loop\nOakhallow, TX 00790.", "address", "966 Lantern Loop\nOakhallow, TX 00790"), ("at Unit 74, 35 Foxglove Road, Wexbury ZZ3 5QX", "address", "Unit 74, 35 Foxglove Road, Wexbury ZZ3 5QX"),
        ("an Kranichgasse 74a, 00479 Neustrehlen", "address", "Kranichgasse 74a, 00479 Neustrehlen"), (": 161 bis, rue de l'Étang-Noir, 00423 Saint-Orvain.", "address", "161 bis, rue de l'Étang-Noir, 00423 Saint-Orvain"), ("退货寄至澄河市云堇路86号6栋27室。", "address", "澄河市云堇路86号6栋27室"),
    ],
)
def test_forms(text, kind, piece):
    assert (kind, piece) in {(c.kind, text[c.start : c.stop]) for c in pii.candidates(text) if c.sure}


@pytest.mark.parametrize("text", ["The gain@1kHz figure", "Firmware 12.34.23.78 reports", "Lot 98765821 was", "Serial 1000-2000-6100 is", "Order code SR55501047-T", "DS-0147-24-4417", "Section 4.26, Table 17"])
def test_no_forms(text):
    assert not [c for c in pii.candidates(text) if c.sure]


def test_names_are_learned_from_the_corpus(spark):
    rng = random.Random(6)
    given, family = ["Maren", "Tobias", "Joan", "Nigel"], ["Holvock", "Pelvling", "Quormark", "Tarvstone", "Lurdwick"]
    texts = [None, ""]
    for i in range(150):
        name = f"{rng.choice(given)} {rng.choice(family)}"
        texts.append(f"# A{i} Gate Driver\n\nA Wien Bridge drifts by 4 %.\n\nContact: {name}; tel. +1 555 555 {i:04d}\n\nUse a Kelvin Bridge here.")
        texts.append(f"A Schmitt Trigger cleans edges.\n\nThanks to {rng.choice(given)} {rng.choice(family)} for the review. The Gate Driver is shown.")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("kind", scanfix.F.lit(1))
    names = {r.item_text for r in pii.find_personal(docs).where("kind = 'person_name'").collect()}
    assert names and all(n.split()[0] in given and n.split()[1] in family for n in names)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs.drop("kind")).collect()}
    assert clean[0] is None and clean[1] == "" and len(clean) == len(texts)
    assert "Contact: [PERSON]; tel. [PHONE]" in clean[2] and "Wien Bridge" in clean[2]
    assert "Thanks to [PERSON] for" in clean[3]
    assert pii.find_personal(docs.limit(0)).count() == 0


def test_choice_without_overlaps_is_the_best_one():
    rng = random.Random(8)
    for _ in range(300):
        every = [{"start": (a := rng.randrange(30)), "stop": a + rng.randrange(1, 8), "bits": rng.choice([None, 1.0, 2.5, 4.0]), "kind": "x", "item": ""} for _ in range(rng.randrange(9))]
        kept = pii.choose(every)
        cross = lambda a, b: a["start"] < b["stop"] and b["start"] < a["stop"]
        assert not any(cross(a, b) for i, a in enumerate(kept) for b in kept[:i])
        sure = [c for c in kept if c["bits"] is None]
        free = [c for c in every if c["bits"] is not None and not any(cross(c, s) for s in sure)]
        sums = [sum(c["bits"] for j, c in enumerate(free) if m >> j & 1) for m in range(1 << len(free)) if not any(cross(free[i], free[j]) for i in range(len(free)) for j in range(i) if m >> i & 1 and m >> j & 1)]
        assert sum(c["bits"] for c in kept if c["bits"] is not None) == max(sums)


def test_rare_given_names_are_kept_in_copies(spark):
    phrase = [f"Part {i}x Gate Driver {w} {i}." for i, w in enumerate(["holds", "runs", "heats", "rests"] * 20)]
    contacts = [f"Contact: {g} {f}; tel. +1 555 555 {i:04d}" for i, (g, f) in enumerate([("Maren", "Holvock"), ("Tobias", "Pelvling"), ("Maren", "Pelvling"), ("Tobias", "Holvock")] * 8)]
    copies = ["Contact: Ysolde Quormark; tel. +1 555 555 9999"] * 6
    docs = spark.createDataFrame(list(enumerate(phrase + contacts + copies)), "doc_id bigint, text string")
    found = pii.find_personal(docs).where("kind = 'person_name'").groupBy("item_text").count().collect()
    counts = {r.item_text: r["count"] for r in found}
    assert counts["Ysolde Quormark"] == 6 and "Gate Driver" not in counts


def test_chinese_names_of_one_character_families(spark):
    plain = [f"引脚 {i} 应通过电阻连接到模拟地，王水温度高于 {i} 度。" for i in range(40)]
    contacts = [f"请找{n}，电话：010-0000-{4000 + i}" for i, n in enumerate(["张伟明", "李娜", "张秀娜", "李伟"] * 8)]
    texts = [*plain, *contacts, "张伟明与李娜共同完成了布局评审。"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {(r.doc_id, r.item_text) for r in pii.find_personal(docs).where("kind = 'person_name'").collect()}
    assert {(40, "张伟明"), (41, "李娜")} <= found and not [x for i, x in found if i < 40]
