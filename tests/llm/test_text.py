"""Contamination, tokens, languages, personal data, pages and urls."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from curbcount.llm import byte_bpe, common, decontaminate, html_text, language_id, personal_data, queries, token_counts, url_reputation
from tests.llm.conftest import LONG, PASSAGE, base_rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def collected(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# ---------------------------------------------------------------- contamination

BENCH = [(1, PASSAGE), (20, PASSAGE.upper() + " tail"), (3, "one"), (4, ""), (5, None), (None, "null id"), (6, "Alpha, beta; gamma delta!"), (6, "again")]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(rows, items):
    windows = []
    for item, text in items:
        w = plain_words(text)
        windows += [(item, w[k : k + 13]) for k in range(max(1, len(w) - 12)) if w]
    out = []
    for i, text, *_ in rows:
        w, hit, own = plain_words(text), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    own |= {str(item)} - {"None"}
        sha = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(own), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1 << 20, 200])
def test_contamination_equals_brute_force(spark, docs, limit):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    found = decontaminate.find_contamination(docs, bench, automaton_bytes=limit)
    assert collected(found.select("record.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == brute_hits(base_rows(), BENCH)


def test_contamination_drops_and_empty_tables(spark, docs, none):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not r[5] for r in brute_hits(base_rows(), BENCH))
    assert decontaminate.drop_contaminated(none, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_spans_map_to_the_original():
    text = "Ä  x—Alpha,\nBETA!! ñ"
    assert plain_words(text) == ["Ä", "x—alpha", "beta", "ñ"]
    assert [text[a:b] for a, b in decontaminate.character_spans(text, [(0, 1), (1, 3)])] == ["Ä", "x—Alpha,\nBETA"]


def test_a_worker_keeps_the_objects_of_one_operator():
    first = common.kept(("a",), list)
    assert common.kept(("a",), list) is first
    assert common.kept(("b",), dict) == {} and common.kept(("a",), list) is not first
    common.release()
    assert not common._kept


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_bpe_equals_the_library(spark, docs, none, library):
    wanted = sorted(((i, *digests(library, t or "")) for i, t, *_ in base_rows()), key=repr)
    assert collected(byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)) == wanted
    assert byte_bpe.round_trip(none, RANKS, public_tokenizers.PATTERN).count() == 0


def digests(library, text):
    ids = library.encode_ordinary(text)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_bpe_round_trip_of_a_table(docs):
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN).select("doc_id", "text")
    assert collected(back) == sorted(((r[0], r[1] or "") for r in base_rows()), key=repr)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="ab =é\n", max_size=400)), max_size=4))
def test_bpe_of_any_text(bpe, library, texts):
    coded = bpe.encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library.encode_ordinary(t) for t in texts]
    assert bpe.decode(coded) == [t.encode() for t in texts]


def test_bpe_of_long_words(bpe, library):
    rng = random.Random(3)
    texts = ["a" * 2000, "ab" * 900, " " * 1500 + "x", "é" * 700, "".join(rng.choice("abcdefgh") for _ in range(3000)), "日本語" * 300]
    assert [np.frombuffer(c, "<u4").tolist() for c in bpe.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_bpe_unknown_id(bpe):
    with pytest.raises(ValueError):
        bpe.decode([np.array([60_000], "<u4").tobytes()])


def test_token_counts_equal_the_library(docs, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = []
    for i, t, *_ in base_rows():
        n = len(model.encode(t or "", num_threads=1))
        wanted.append((i, len((t or "").encode()), n, n > 4096))
    assert collected(token_counts.count_tokens(docs, PIECES)) == sorted(wanted, key=repr)
    assert token_counts.count_tokens(none, PIECES).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n\t▁é日<s>/", max_size=80))
def test_token_counts_of_texts_cut_into_parts(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    old, token_counts.LONG_TEXT = token_counts.LONG_TEXT, 6
    try:
        assert token_counts.counter(PIECES)([text, LONG[:50] + text]) == [len(model.encode(t)) for t in (text, LONG[:50] + text)]
    finally:
        token_counts.LONG_TEXT = old


def test_token_counts_by_the_other_library(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    wanted = sorted((len(own.encode(r[1] or "", add_special_tokens=False).ids) for r in base_rows()))
    assert sorted(r.n_tokens for r in token_counts.count_tokens(docs, path).collect()) == wanted


# ---------------------------------------------------------------- languages


def labelled(n, seed=1):
    rng = random.Random(seed)
    parts = {"xx": ["ka", "lu", "mo", "ti"], "yy": ["schn", "ber", "ung", "keit"], "zz": ["ción", "ña", "dor", "esa"]}
    out = []
    for k in range(n):
        lang = rng.choice(sorted(parts))
        out.append((k, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(3, 40))), lang))
    return out


def test_languages_of_held_out_rows(spark):
    rows = labelled(600) + [(900, None, "xx"), (901, "12 -- 34", "yy"), (902, "", None), (None, "kalumo tika", None), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(frame)
    found = language_id.predict(frame, model, keep_text=False).select("record.doc_id", "record.lang", "lang_pred", "score", "rejected").collect()
    assert len(found) == len(rows)
    held = [r for r in found if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in held) <= 0.02 * len(held)
    assert all((r.lang_pred, r.score, r.rejected) == ("und", 0.0, True) for r in found if r.doc_id in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in found)
    folds = {r[0]: r[1] for r in frame.select("doc_id", language_id.held_out(frame.doc_id).alias("h")).collect()}
    assert folds[None] is False and all(folds[k] == (zlib.crc32(str(k).encode()) % 3 == 1) for k in range(50))


def test_a_threshold_keeps_the_stated_risk():
    right, wrong = np.linspace(0.3, 1, 8000), np.linspace(0.2, 0.7, 400)
    chosen = language_id._threshold(right, wrong, np.zeros(0))
    assert chosen == np.quantile(right, language_id.REJECTED_GOOD)  # coverage goes first
    few = np.concatenate([np.full(3, 0.3), np.full(7997, 0.9)])
    chosen = language_id._threshold(few, np.full(400, 0.35), np.full(50, 0.4))
    assert chosen == 0.9 and (np.concatenate([few, np.full(400, 0.35)]) >= chosen).sum() == 7997
    assert language_id._threshold(np.zeros(0), wrong, wrong) == 0.0
    assert language_id._threshold(np.full(10, 0.9), np.zeros(0), np.zeros(0)) == 0.9


def test_languages_of_long_texts_are_learned(spark):
    rows = [(i, " ".join(f"{w}{i % 7}ung" for w in ("sch", "ver", "ent") * 2000), "de") for i in range(30)]
    rows += [(100 + i, " ".join(f"the{i % 5} thing{k % 9}" for k in range(40)), "en") for i in range(300)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert model.languages == ["de", "en"] and model.predict([rows[0][1], rows[50][1]])[0] == ["de", "en"]


def test_language_scores_are_calibrated_and_repeatable():
    rows = [(t, lang) for _, t, lang in labelled(500)]
    model, again = language_id.train(rows), language_id.train(rows)
    assert np.array_equal(model.table, again.table) and 0 < model.threshold < 1
    assert language_id.train([]).predict(["abc"]) [0] == ["und"]


def test_language_stage(docs, none):
    left = language_id.drop_rejected(docs)
    assert left.columns == docs.columns and 0 < left.count() < docs.count()
    assert language_id.drop_rejected(none).count() == 0


# ---------------------------------------------------------------- personal data

EXACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    def passes(kind, own):
        digits = re.sub("[^0-9]", "", own)
        if kind == "ip":
            return all(int(p) <= 255 for p in own.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if passes(k, m[0])] for k, p in EXACT.items()}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB9.@+- ()%1é\n", max_size=60))
def test_exact_spans_equal_brute_force(text):
    assert personal_data.base_spans(text) == brute_spans(text)


def test_exact_spans_of_runs_take_linear_time():
    text = "a" * 300_000 + "@" + "1" * 300_000 + " 1.2.3.4 x@y.z"
    assert personal_data.base_spans(text)["email"] == [(len(text) - 5, len(text))]


@pytest.fixture(scope="module")
def spans():
    return personal_data.train(["the call of and from with version where there will tell"] * 3)


@pytest.mark.parametrize("text, kind", [
    ("please call (415) 555-2671 now", "phone"), ("write to bob at mailhost dot com today", "email"),
    ("card 4111.1111.1111.1111 ok", "card"), ("login from 2001:db8:85a3:1:2:8a2e:370:7334 here", "ip"),
])
def test_added_spans(spans, text, kind):
    assert [k for k, _, _ in spans.choose(text, personal_data.base_spans(text))] == [kind]


def test_numbers_of_the_corpus_without_label_turn_nothing_off():
    rng = random.Random(3)
    def phone():
        return f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    own = personal_data.train([f"please call {phone()} or tel {phone()} and write to bob at mailhost dot com today" for _ in range(400)])
    texts = [f"please call {phone()} now" for _ in range(50)]
    found = [[(k, t[a:b]) for k, a, b in own.choose(t, personal_data.base_spans(t))] for t in texts]
    assert found == [[("phone", t[12:26])] for t in texts]
    mail = "write to bob at mailhost dot com today"
    assert [k for k, _, _ in own.choose(mail, personal_data.base_spans(mail))] == ["email"]


@pytest.mark.parametrize("own, surely", [
    ("on 2024-01-02 at", True), ("on 31.12.1999 at", True), ("isbn 978-3-1610-1484-5 at", True), ("total € 1200 500 at", True), ("paid 1234 500,00 EUR at", True),
    ("version 33.14.15 at", True), ("call 415-555-2671 at", False), ("on 2024-13-41 at", False), ("order 4155552671 at", False),
])
def test_only_clear_numbers_are_negatives(own, surely):
    found = re.search(r"[0-9][0-9 .,-]*[0-9]", own.replace(",00", "   "))
    assert personal_data.ordinary(own, *found.span()) == surely


@pytest.mark.parametrize("address", ["2001:db8::1", "fe80::1", "::1", "2001:db8::ff00:42:8329", "2001:DB8:0:1::a", "2001:db8:85a3:1:2:8a2e:370:7334"])
@pytest.mark.parametrize("around", ["login from {} here", "host {}.", "ip:{}, then", "server [{}]:443 up"])
def test_compressed_addresses(spans, address, around):
    text = around.format(address)
    if address != "::1" or "ip:" not in around:
        at = text.index(address)
        assert spans.choose(text, personal_data.base_spans(text)) == [("ip", at, at + len(address))]


@pytest.mark.parametrize("text", ["at 12:30:45 then", "until 23:59:59:12 today", "class abc::add is", "ratio 1:2:3 of"])
def test_colons_of_other_kinds_are_left_alone(spans, text):
    assert [k for k, _, _ in personal_data.proposals(text)] == ["ip"] and spans.choose(text, personal_data.base_spans(text)) == []


def test_address_proposals_of_runs_take_linear_time():
    assert [s for s in personal_data.proposals("a" * 200_000 + ":" * 200_000 + "ab:" * 100_000 + "z") if s[2] - s[1] > 41] == []


@pytest.mark.parametrize("text", ["order 2024-01-02 total 12,50 EUR", "version 3.14.15", "look at the end of page 12", "ISBN 978-3-1610-1484-5"])
def test_ordinary_numbers_are_left_alone(spans, text):
    assert spans.choose(text, personal_data.base_spans(text)) == []


def test_personal_data_of_a_table(docs, none, spans):
    found = {r[0].doc_id: r for r in personal_data.find_personal(docs, spans).where("record.doc_id IS NOT NULL").collect()}
    own = found[15]
    assert [own[f"n_{k}"] for k in personal_data.KINDS] == [1, 1, 1, 1]
    text = base_rows()[15][1]
    base = ",".join(f"{k}:{a}:{b}" for k, v in brute_spans(text).items() for a, b in v)
    assert own.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and own.spans == base
    assert own.redacted == "mail [email] or [phone], card [card], host [ip]"
    assert found[3].spans == "" and found[3].redacted == ""
    assert personal_data.find_personal(none, spans).count() == 0 and personal_data.fit(none).thresholds


# ---------------------------------------------------------------- pages


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p>a<p>b <b>c</b>d", "a\n\nb cd"), ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>x<li>y<ol start=3><li>q<li>r</ol></ul>tail", "- x\n- y\n  3. q\n  4. r\n\ntail"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>b<td>2</table>after", "Name   Qty\napple  10\nb      2\n\nafter"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"), ("<pre>\n a\n   b</pre>", " a\n   b"),
    ("<head><title>t</title><body>x<script>if(a<b){}</script><style>p{}</style>", "x"), ("<head><title>t</title>x", "x"),
    ("a<div hidden>no</div><div style='display: none'>no</div><span style='visibility:hidden'>no</span>b", "ab"),
    ("a &lt; b &amp; c <", "a < b & c <"), ("a<!-- no -->b<div", "ab"), ("<dl><dt>T<dd>D</dl>", "T\n    D"),
    ("<p>" + "\n w " * 3, "w w w"), ("<details><summary>s</summary>no</details>", "s"), ("<img alt='pic'> <input value=yes>", "pic yes"),
])
def test_visible_text(html, text):
    assert html_text.visible_text(html) == text


def test_deep_and_random_pages():
    assert html_text.visible_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "end").split() == ["deep", "end"]
    rng = random.Random(5)
    for _ in range(300):
        page = "".join(rng.choice(["<p>", "</p>", "<table>", "<td>", "</table>", "<tr>", "<li>", "<ul>", "</ul>", "<b>", "</i>", "w ", "&amp;"]) for _ in range(40))
        assert html_text.visible_text(page).count("w") == page.count("w")


@pytest.mark.parametrize("html, text", [
    ("<table><tbody><form><tr><td>a</td></tr></form></tbody></table>", "a"), ("<table><tr><form><td>a</td><td>b</td></form></tr></table>", "a  b"),
    ("<table><tbody>note<tr><td>a</table>", "note\n\na"), ("<table><tbody><div>note</div><tr><td>a<td>b</table>", "note\n\na  b"),
    ("<table><thead><div>note<tr><td>a<tr><td>b</table>", "note\n\na\nb"), ("<table hidden><tbody>note<tr><td>no</table>", "note"),
    ("<table><colgroup>note<tr><td>a</table>", "note\n\na"), ("x<table><tr><td>y<table><tbody>z<tr><td>in</table></table>", "x\n\nyz\n\nin"),
])
def test_what_stands_in_a_table_by_mistake_stays(html, text):
    assert html_text.visible_text(html) == text


@pytest.mark.parametrize("html, text", [
    ("so <math><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math> holds", "so a=1/2 holds"),
    ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs>no<g><text>Left</text><text>Right <tspan>side</tspan></text></g></svg>end", "Left\nRight side\nend"),
    ("<svg><foreignObject><p>x</p></foreignObject></svg>", "x"), ("<svg><path d='M0'>a<p>b</p>c", "b\n\nc"),
    ("pick <select><option>one<option selected>two<option>three</select>!", "pick two!"), ("<select><option disabled>a<option>b<optgroup><option>c</select>", "b"),
    ("<select multiple><option>a<option>b</select>", "a\nb"), ("<select><option>a<select>tail", "atail"),
    ("<span style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</span>", "yes"), ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>x</ul>", "- x"),
    ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>x</table>", "x"), ("<table><tr style='visibility:collapse'><td>no<tr><td>x</table>", "x"),
    ("<table><tr><td style='visibility:hidden'>no<td>x<tr><td>ab<td>y</table>", "    x\nab  y"),
])
def test_formulas_drawings_lists_and_visibility(html, text):
    assert html_text.visible_text(html) == text


def test_random_tables_keep_their_words():
    rng = random.Random(6)
    tags = ["p", "table", "tbody", "thead", "tfoot", "form", "div", "tr", "td", "th", "caption", "colgroup", "li", "ul", "b"]
    for size in (40, 40, 1500):
        for _ in range(300 if size == 40 else 10):
            page = "".join("w " if rng.random() < 0.3 else f"<{'/' * (rng.random() < 0.3)}{rng.choice(tags)}>" for _ in range(size))
            assert html_text.visible_text(page).count("w") == page.count("w")


def test_pages_of_a_table(spark):
    frame = spark.createDataFrame([(1, "<p>x</p>", "t"), (1, "<p>x</p>", "t"), (None, None, None)], "page_id bigint, html string, text string")
    assert collected(html_text.extract_text(frame)) == [(1, "x", 1, 1), (1, "x", 1, 1), (None, "", 0, 0)]
    assert html_text.extract_text(frame.limit(0)).count() == 0


# ---------------------------------------------------------------- urls


def test_urls(spark):
    rows = [
        (1, "https://A.Example.ORG/es/x?q#f"), (2, "http://example.org/en/1"), (3, "http://example.org/en/2"), (4, "http://x.com/fr/"), (5, "http://x.com/de/1"),
        (6, None), (7, "no scheme"), (8, "http://y.net"), (9, "http://y.net?a=/b"), (9, "http://y.net?a=/b"), (None, "http://y.net/"), (10, "http://badorg/"), (11, "ftp://z.co.uk/:p"),
        *((100 + k, f"http://bad.net/{k}") for k in range(40)), *((200 + k, f"http://good.net/{k}") for k in range(40)),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 AS host", "2 AS n", "3 AS verdict")
    outcomes = spark.createDataFrame([(100 + k, 1) for k in range(40)] + [(200 + k, 0) for k in range(40)] + [(None, 1), (8, None)], "page_id bigint, bad int")
    found = {(r.page_id, r.host): r for r in url_reputation.judge_urls(frame, outcomes, queries.RULES).collect()}
    got = {k[0]: (r.host, r.path, r.rule, r.verdict) for k, r in found.items()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3][2:] == ("org/", "allow") and got[4][2:] == ("com/fr/", "allow") and got[5][2:] == ("com/de/", "block")
    assert got[6] == got[7] == ("", "", None, "allow") and got[8] == ("y.net", "", None, "allow") and got[10][2] is None
    assert {got[100 + k][3] for k in range(40)} == {"block"} and {got[200 + k][3] for k in range(40)} == {"allow"}
    assert url_reputation.judge_urls(frame, outcomes, queries.RULES).count() == len(rows)
    assert {r.verdict for r in url_reputation.judge_urls(frame.where("page_id < 100"), outcomes.limit(0), []).collect()} == {"allow"}
    assert url_reputation.judge_urls(frame.limit(0), outcomes, queries.RULES).count() == 0


def test_hosts_without_labels_have_the_level_above(spark):
    rows = [
        *((k, f"http://h{k % 4}.bad.net/{k}") for k in range(200)), *((200 + k, f"http://h{k % 4}.good.net/{k}") for k in range(200)),
        *((400 + k, f"http://d{k % 8}.evil/{k}") for k in range(200)), *((600 + k, f"http://d{k % 8}.fine/{k}") for k in range(200)),
        (900, "http://new.bad.net/"), (901, "http://new.good.net/"), (902, "http://new.d9.evil/"), (903, "http://new.d9.fine/"), (904, "http://new.other/"), (None, "http://x.bad.net/"),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string")
    outcomes = spark.createDataFrame([(k, int(k < 200 or 400 <= k < 600)) for k in range(800)], "page_id bigint, bad int")
    found = {r.page_id: r for r in url_reputation.judge_urls(frame, outcomes, []).collect()}
    assert {k: found[k].verdict for k in (900, 901, 902, 903, 904, None)} == {900: "block", 901: "allow", 902: "block", 903: "allow", 904: "allow", None: "block"}
    assert min(found[900].bad_mean, found[902].bad_mean) > 0.9 and found[904].bad_mean == 0.5 and found[900].bad_low < found[0].bad_low
    # labelled hosts are judged as without the others
    alone = {r.page_id: r for r in url_reputation.judge_urls(frame.where("page_id < 900"), outcomes, []).collect()}
    assert all(abs(found[k].bad_low - alone[k].bad_low) < 1e-8 for k in alone)


def test_domains(spark):
    frame = spark.createDataFrame([("a.b.example.com",), ("a.shop.co.uk",), ("co.uk",), ("localhost",), ("",)], "host string")
    found = frame.select(url_reputation.suffix_of(frame.host), url_reputation.domain_of(frame.host)).collect()
    assert [tuple(r) for r in found] == [("com", "example.com"), ("co.uk", "shop.co.uk"), ("co.uk", "co.uk"), ("localhost", "localhost"), ("", "")]


def test_url_plan_has_no_python(spark):
    plan = queries.op10_url_reputation(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- pipeline


def test_pipeline_stage_by_stage(spark, docs, none, tmp_path):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for start, least in ((docs, 1), (none, 0)):
        now, counts = start, [start.count()]
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{least}-{name}"
            stage(spark, now, str(tmp_path)).write.parquet(path)
            now = spark.read.parquet(path)
            counts.append(now.count())
            assert k == len(corpus_pipeline.STAGES) - 1 or now.columns == start.columns
        assert counts == sorted(counts, reverse=True) and counts[-1] >= least
        assert {"doc_id", "token_ids", "n_tokens"} <= set(now.columns)
