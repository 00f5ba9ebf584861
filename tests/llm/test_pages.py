"""Operators on pages, urls, archives and conversations."""

import base64
import hashlib
import random
import time
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tradeflow.llm import chat, html_text, queries, url_rules, warc
from tradeflow.workspace import new_folder

# --- main text -----------------------------------------------------------------

PARAGRAPHS = ["First words, with &amp; signs &lt;b&gt; and more of them, so that it is long enough to be text.",
              "Second one\n  has   white&nbsp;space. It goes on, and on, and on; then it ends.", "Short."]
WANT = "Head line\nFirst words, with & signs <b> and more of them, so that it is long enough to be text.\n" \
       "Second one has white space. It goes on, and on, and on; then it ends.\nShort."


def page(body_of_article, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>x > y</title><style>p{{}}</style><script>if (a<b) '</p>'</script></head>" \
           f"<body class='has-sidebar'>{before}{body_of_article}{after}</body></html>"


def paragraphs(tag="p"):
    return "<h1>Head line</h1>" + "".join(f"<{tag}>{p}</{tag}>" for p in PARAGRAPHS)


NOISE = [
    "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two, three.</a></li></ul></nav>",
    "<header><h2>Site name</h2><p>A slogan, which is quite long, and has marks.</p></header>",
    "<footer><p>All rights reserved, &copy; someone, with a rather long sentence in it.</p></footer>",
    "<aside><p>Something else to read, which is long, too, and has marks.</p></aside>",
    "<div class='cookie-notice'><p>We use cookies, as everyone does, and so on.</p></div>",
    "<div id=\"sidebarLeft\"><div><p>Side text, long, with marks, and more.</p></div></div>",
    "<div class='ad'>Buy this, now, for less, because it is good.</div>",
    "<form action='/x'><label>Your name, please.</label><input><button>Go</button></form>",
    "<section class='comments'><article class='comment'><p>I agree, really, with all of this text, yes.</p></article></section>",
    "<!-- <p>not shown, not at all, never.</p> -->", "<div role='navigation'>More, links, here.</div>",
    "<div id='site-header'><h1>Site, the best of all.</h1><p>A slogan, long, with marks.</p></div>",
    "<noscript><p>Turn on scripts, please, now.</p></noscript>", "<p hidden>Not seen, at all, by anyone here.</p>",
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div class='post'>{}</div></main>",
                                  "<div id='content'>{}</div>", "<div><div class='entry-content'>{}</div></div>"])
@pytest.mark.parametrize("noise", [NOISE, NOISE[:3], []])
def test_main_text(wrap, noise):
    html = page(wrap.format(paragraphs()), "".join(noise[::2]), "".join(noise[1::2]))
    assert html_text.main_text(html) == WANT


def test_main_text_of_noise_inside_and_open_tags():
    inner = "<h1>Head line</h1><p><b>" + PARAGRAPHS[0] + "<br><p>" + PARAGRAPHS[1] + NOISE[6] + NOISE[8] + "<p>" + PARAGRAPHS[2]
    assert html_text.main_text(page(f"<article>{inner}</article>", NOISE[0], NOISE[2])) == WANT
    assert html_text.main_text(page(f"<article>{inner}", NOISE[0])[:-11]) == WANT
    assert html_text.main_text(page(f"<article>{inner}</article>", "<div class='ad'>never closed")) == WANT


def test_main_text_of_odd_pages():
    assert [html_text.main_text(x) for x in (None, "", "<p></p>", "<<<", "a < b", "<p>x</p", "&#x41;&nosuch; &amp")] == [
        "", "", "", "<<<", "a < b", "x", "A&nosuch; &"]
    long = "".join(f"<p>word {i}, and more.</p>" for i in range(20_000))
    assert html_text.main_text(f"<article>{long}</article>").count("\n") == 19_999
    deep = "<div>" * 5000 + "<p>in here.</p>"
    assert html_text.main_text(deep) == "in here."


@pytest.mark.parametrize("wrap", ["<div class='content no-sidebar'>{}</div>", "<div class='with-menu'>{}</div>", "<div class='sidebar-right'>{}</div>",
                                  "<form action='./a.aspx'><div>{}</div></form>", "<div class='comments-open'><article>{}</article></div>"])
def test_main_text_in_doubtful_places(wrap):
    assert html_text.main_text(page(wrap.format(paragraphs()))) == WANT
    assert html_text.main_text(page(wrap.format(paragraphs()), NOISE[0] + NOISE[4], NOISE[7] + NOISE[8])) == WANT


BIG_NOISE = ["<div class='sidebar'>{}</div>", "<div class='cookie-consent'>{}</div>", "<div class='advert'>{}</div>", "<form action='/x'>{}</form>",
             "<div id='menu'>{}</div>", "<div id='comments'>{}</div>", "<section class='comment-list'>{}</section>", "<div role='search'>{}</div>",
             "<div class='related'><div class='teaser'>{}</div></div>", "<footer>{}</footer>", "<aside>{}</aside>", "<nav>{}</nav>"]


@pytest.mark.parametrize("noise", BIG_NOISE)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id='content'>{}</div>"])
def test_noise_of_any_size_is_left_out(noise, wrap):
    much = noise.format("".join(f"<p>Noise number {i}, which is long; it has marks, and goes on, and on.</p>" for i in range(60)))
    own = "<h1>Head line</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    assert html_text.main_text(page(wrap.format(own), much)) == WANT
    assert html_text.main_text(page(wrap.format(own), "", much)) == WANT
    assert html_text.main_text(page(wrap.format(own + much))) == WANT


def test_comments_as_articles_are_left_out():
    many = "".join(f"<article class='comment'><p>I agree, number {i}, with all of it, really.</p></article>" for i in range(30))
    for comments in (f"<div class='comments'>{many}</div>", "<div id='comments'><article><p>A lone one, but long, with marks, and more.</p></article></div>"):
        for wrap in ("<article>{}</article>", "<div class='text'>{}</div>"):
            assert html_text.main_text(page(wrap.format(paragraphs()), "", comments)) == WANT


def some_page(r):
    """A random well-formed page; an article in a menu would end it, so there is none."""
    names = ["", "", "", "content", "sidebar", "comments", "no-sidebar", "ad", "header", "related", "post comment"]

    def words():
        return " ".join(r.choice(["word", "and, more", "end.", "x &amp; y", "é"]) for _ in range(r.randrange(1, 12)))

    def part(depth, menu=False):
        if depth == 0 or r.random() < 0.25:
            tag = r.choice(["p", "p", "p", "h1", "h2", "li"])
            return f"<{tag}>{words()} <b>{words()}</b></{tag}>" if r.random() < 0.9 else words()
        tag = r.choice(["div"] * 6 + ["section", "article", "main", "form", "ul", "nav", "header", "footer", "aside", "span"])
        tag = "div" if menu and tag in ("article", "main") else tag
        menu = menu or tag in ("nav", "header", "footer", "aside")
        own = f' class="{r.choice(names)}"' if r.random() < 0.5 else f' id="{r.choice(names)}"'
        return f"<{tag}{own}>" + "".join(part(depth - 1, menu) for _ in range(r.randrange(1, 5))) + f"</{tag}>"

    return "<html><body>" + "".join(part(r.randrange(1, 5)) for _ in range(r.randrange(1, 4))) + "</body></html>"


@pytest.mark.parametrize("seed", range(4))
def test_main_text_equals_plain_form(seed):
    r = random.Random(seed)
    for _ in range(250):
        shown = some_page(r)
        assert html_text.main_text(shown) == brute.main_text(shown, html_text), shown


@pytest.mark.parametrize("shown", ["<b>" * 100_000 + "<p>x, y.</p>" * 1000, "<b><p>a, b.</p>" * 8000, "<span>word<p>text, t.</p>" * 8000,
                                   "<div class='ad'>" * 50_000 + "<p>a, b.</p>" * 2000, "</x>" * 100_000, "< " * 100_000,
                                   "<article>" * 50_000 + "a, b.", "<li>a, b." * 50_000, "<tbody>" * 50_000 + "<tr>" * 50_000])
def test_open_tags_take_linear_time(shown):
    started = time.process_time()
    html_text.main_text(shown)
    assert time.process_time() - started < 10  # below 2 s by itself; a quadratic walk takes minutes


def test_headings_and_sections_named_by_their_titles():
    parts = "".join(f"<section id='{i}'><h2 id='{i}'>{i}</h2><p>{PARAGRAPHS[0]}</p></section>" for i in ("discussion", "search", "related-work"))
    text = html_text.main_text(page(f"<article>{paragraphs()}<h2 id='comments'>About comments</h2><p>{PARAGRAPHS[1]}</p>{parts}</article>"))
    assert text.startswith(WANT + "\nAbout comments\n") and all(f"\n{i}\n" in text for i in ("discussion", "search", "related-work"))
    assert text.count("First words") == 4


def test_nothing_above_the_threshold_is_dropped():
    body = "".join(f"<p>Sentence {i}, which is long enough, and goes on and on.</p>" for i in range(30))
    lead = "<div class='intro'><p>A lead, of a sentence or two, that stands beside the text.</p></div>"
    rows = "".join(f"<li>Item {i}, described with care, and at some length.</li>" for i in range(40))
    text = html_text.main_text(f"<div>{lead}<div class='text'>{body}</div></div>")
    assert text.startswith("A lead,") and text.count("\n") == 30
    text = html_text.main_text(f"<div><ul>{rows}</ul><p>At the end, some words, and a few more of them.</p></div>")
    assert text.endswith("a few more of them.") and text.count("\n") == 40
    text = html_text.main_text(f"<div><h1>Top</h1><h2>Below</h2><div class='text'>{body}</div></div>")
    assert text.startswith("Top\nBelow\nSentence 0,")


def test_extraction_keeps_columns(spark):
    pages = spark.createDataFrame([(None, "u", "<p>a</p>", "t"), (1, None, None, None)], "page_id bigint, url string, html string, text string")
    rows = html_text.extracted(pages)
    assert rows.columns == ["page_id", "url", "text", "n_chars"]
    assert Counter(map(tuple, rows.collect())) == Counter([(None, "u", "a", 1), (1, None, "", 0)])
    assert html_text.extracted(pages.limit(0)).count() == 0


# --- urls ------------------------------------------------------------------------


def test_url_rules(spark):
    urls = {
        "https://WWW.Example.COM/en/x?y": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com/EN/": ("example.com", "/EN/", "com/", "allow"), "http://example.com": ("example.com", "", None, "allow"),
        "x://net/es/#a": ("net", "/es/", "net/es/", "block"), "x://a.net/fr": ("a.net", "/fr", None, "allow"),
        "http://m.casino-win.org/": ("m.casino-win.org", "/", None, "block"), "http://casinos.org/ads/": ("casinos.org", "/ads/", None, "allow"),
        "x://y://com/": ("y:", "//com/", None, "allow"), "no scheme.com/": ("", "", None, "allow"), "": ("", "", None, "allow"),
        "http://com:80/": ("com:80", "/", None, "allow"), "http://ex\nample.com/en/": ("ex\nample.com", "/en/", "com/", "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, "old") for i, u in enumerate(urls)] + [(None, "http://com/", "old"), (None, "http://com/", "old")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    found = url_rules.judged(pages, queries.URL_RULES + list(url_rules.COMMON_BLOCKS))
    got = found.select("page_id", "host", "path", F.when(F.col("rank") >= 1000, F.col("rule")), "verdict").collect()
    want = [(i, *v) for i, v in enumerate(urls.values())] + [(None, "com", "/", "com/", "allow")] * 2
    assert Counter(map(tuple, got)) == Counter(want)
    assert url_rules.judged(pages.limit(0), queries.URL_RULES).count() == 0


def test_rules_without_tokens_run_everywhere(spark):
    pages = spark.createDataFrame([("http://a.b/cde",), ("http://a.b/x",)], "url string")
    rules = [url_rules.UrlRule("any", "block", "c[d]e", ()), url_rules.prefix_rule("a.b/c", "allow", -1)]
    assert rules[1].tokens == ("a", "b")
    found = {r["url"]: r["rule"] for r in url_rules.judged(pages, rules).collect()}
    assert found == {"http://a.b/cde": "any", "http://a.b/x": None}


# --- archives ----------------------------------------------------------------------


def test_archive_round_trip(spark):
    start = "WARC/1.1\r\n"
    payloads = ["", None, "same", "same", "é漢\r\n\r\nx", start, f"a\r\n\r\n{start}b{start}", f"a\r\n\r\n{start}b{start}",
                "x" * 300_000, "\r\n\r\n", "WARC", f"{start[:5]}é{start}é\n{start}"]
    rows = [(i, f"http://h/{i}\r\nX: y" if i % 2 else None, p, "z") for i, p in enumerate(payloads)]
    pages = spark.createDataFrame([*rows, (None, "u", "alone", "z"), rows[2]], "page_id bigint, url string, html string, digest string")
    folder = new_folder(spark, "archive")
    warc.write_archive(warc.captures_to_write(pages.repartition(3)), folder)
    captures = warc.assembled(warc.read_records(spark, folder)).collect()
    assert len(captures) == len(rows) + 1  # identical rows are one capture
    assert all(r["request"] and r["metadata"] and r["response"] for r in captures)
    found = {}
    for r in captures:
        field = r["metadata"]["fields"].split("page-id: ")[1].strip()
        found[int(field) if field else None] = r["response"]
    by_payload = {}
    for i, p in enumerate(payloads):
        by_payload[p or ""] = i
    for i, p in enumerate(payloads):
        data, first = (p or "").encode(), by_payload[p or ""]
        got = found[i]
        assert (got["payload_bytes"], got["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (got["type"], got["refers_to"]) == (("response", None) if first == i else ("revisit", str(first)))
        if first == i:
            assert bytes(got["payload"]) == data
    assert bytes(found[None]["payload"]) == b"alone"


def test_small_payloads_may_all_be_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    folder = new_folder(spark, "archive")
    warc.write_archive(warc.captures_to_write(pages, least_bytes=3), folder)
    kinds = warc.assembled(warc.read_records(spark, folder)).select("response.type", "metadata.fields").collect()
    assert {int(f.split(":")[1]): t for t, f in kinds} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_foreign_transactions(spark, tmp_path):
    def record(kind, own, block, extra=""):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{own}>\r\n{extra}Content-Type: application/http\r\n"
        return f"{head}content-length: {len(block.encode())}\r\n\r\n{block}\r\n\r\n"
    text = record("request", "q", "GET / HTTP/1.1\r\n\r\n") + record(
        "response", "r", "HTTP/1.1 200 OK\r\n\r\npayé", "WARC-Concurrent-To: <q>\r\n") + record("metadata", "m", "alone")
    (tmp_path / "a.warc").write_bytes(text.encode())
    rows = {r["capture_id"]: r for r in warc.assembled(warc.read_records(spark, str(tmp_path))).collect()}
    assert rows["<q>"]["request"]["record_id"] == "<q>" and bytes(rows["<q>"]["response"]["payload"]) == "payé".encode()
    assert rows["<m>"]["response"]["type"] is None and rows["<m>"]["request"] is None
    (tmp_path / "a.warc").write_bytes(text.encode()[:-9])
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(spark, str(tmp_path)).collect()


def archive(*records):
    text = b""
    for kind, own, block, *named in records:
        head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <" + own.encode() + b">"]
        head += [b"WARC-Concurrent-To: <" + n.encode() + b">" for n in named]
        kind = b"application/warc-fields" if kind == "metadata" else b"application/http"
        text += b"\r\n".join([*head, b"Content-Type: " + kind, b"Content-Length: %d" % len(block)]) + b"\r\n\r\n" + block + b"\r\n\r\n"
    return text


ASK, ANSWER = b"GET / HTTP/1.1\r\n\r\n", b"HTTP/1.1 200 OK\r\n\r\n"


@pytest.mark.parametrize("links", [
    (["r"], [], ["r"]), ([], ["q"], ["r"]), (["r", "m"], ["q"], ["q"]), (["x"], ["y", "x"], ["y"]), (["m"], ["m", "q"], ["q", "r", "gone"])])
def test_linked_records_are_one_capture(spark, tmp_path, links):
    ask, answer, about = links
    (tmp_path / "a.warc").write_bytes(archive(
        ("request", "q", ASK, *ask), ("response", "r", ANSWER + b"pay\xff\xfe", *answer), ("metadata", "m", b"page-id: 7\r\n", *about),
        ("response", "alone", ANSWER), ("request", "q2", ASK, "r2"), ("response", "r2", ANSWER + b"x")))
    rows = warc.assembled(warc.read_records(spark, str(tmp_path))).collect()
    found = {r["response"]["record_id"]: r for r in rows}
    assert len(rows) == 3 and found["<alone>"]["request"] is None and found["<r2>"]["request"]["record_id"] == "<q2>"
    row = found["<r>"]
    assert (row["request"]["record_id"], row["metadata"]["record_id"]) == ("<q>", "<m>")
    assert row["capture_id"] == "<r>"
    payload = row["response"]["payload"]
    assert bytes(payload) == b"pay\xff\xfe" and row["response"]["payload_bytes"] == 5
    assert row["response"]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_revisits_name_the_record_they_refer_to(spark):
    pages = spark.createDataFrame([(1, "http://a/x y", "same"), (2, None, "same"), (3, "http://c/", "other")], "page_id bigint, url string, html string")
    folder = new_folder(spark, "archive")
    warc.write_archive(warc.captures_to_write(pages), folder)
    records = warc.read_records(spark, folder)
    captures = {r["response"]["type"] + (r["response"]["uri"] or "").removeprefix("http://"): r["response"] for r in warc.assembled(records, payloads=False).collect()}
    assert captures["revisita/x%20y"]["refers_to_record"] == captures["response"]["record_id"]
    assert captures["revisita/x%20y"]["refers_to"] == "2" and captures["responsec/"]["refers_to_record"] is None


def test_empty_archive(spark):
    folder = new_folder(spark, "archive")
    warc.write_archive(warc.captures_to_write(spark.createDataFrame([], "page_id bigint, url string, html string")), folder)
    assert warc.assembled(warc.read_records(spark, folder)).count() == 0


# --- chats -------------------------------------------------------------------------

KEY = ["turn", "version", "copy"]


@pytest.mark.parametrize("seed", range(3))
def test_chat_round_trip(spark, seed):
    r = random.Random(seed)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>", "\n", "\\", "<\\", "[\\\\/INST]", "<<SYS>>", "<</SYS>>",
            "<|end|>\n<|turn|>assistant\n", "x", "é漢😀", " ", "<", "[", "|>"]
    text = lambda: None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randrange(12)))
    rows = [(c, t, r.choice(["user", "assistant", "a\nb\\n<s>", None]), text()) for c in [None, 1, 2, -5] for t in range(r.randrange(1, 9))]
    turns = spark.createDataFrame(rows + rows[:1], "conv_id bigint, turn bigint, role string, text string")
    want = {}
    for c, t, role, x in rows + rows[:1]:
        want.setdefault(c, []).append((t, role or "", x or ""))
    shown = chat.rendered(chat.folded(chat.log_of_turns(turns), KEY))
    found = {x["conv_id"]: x for x in chat.digests(shown, KEY).collect()}
    assert set(found) == set(want)
    for c, told in want.items():
        told.sort(key=lambda m: m[0])
        learned = "".join(x for _, role, x in told if role == "assistant")
        assert tuple(found[c])[1:5] == (
            len(told), hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in told).encode()).hexdigest(),
            len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert sum(len(x["formatted"]) for x in shown.collect()) == sum(x["formatted_chars"] for x in found.values())


def fold_plainly(events):
    """One event after the other; a regenerate forgets what later messages were told so far."""
    logs = {}
    for conv, _, kind, turn, role, text in sorted(set(events), key=lambda e: e[1]):
        logs.setdefault((conv, turn), []).append((kind, role, text or ""))
        if kind == "regenerate":
            for later in [k for k in logs if k[0] == conv and k[1] > turn]:
                del logs[later]
    found = Counter()
    for (conv, turn), log in logs.items():
        own = ["", ""]
        for kind, role, text in log:
            own[0] = own[0] if role is None else role
            own[1] = own[1] + text if kind == "delta" else "" if kind == "regenerate" else text
        found[(conv, turn, *own)] += 1
    return found


@pytest.mark.parametrize("seed", range(3))
def test_folding_equals_replaying(spark, seed):
    r = random.Random(seed)
    events = []
    for conv in range(5):
        for seq in range(r.randrange(1, 40)):
            kind = r.choice(["delta"] * 6 + ["message", "edit", "regenerate"])
            events.append((conv, seq, kind, min(seq // 5, r.randrange(6)), r.choice([None, "user", "assistant"]), r.choice(["a", "b", "", None])))
    log = spark.createDataFrame(events + events[::3] + [(0, 99, "typing", 0, "user", "x")],
                                "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string")
    found = chat.folded(log, ["turn"]).select("conv_id", "turn", "role", "text").collect()
    assert Counter(map(tuple, found)) == fold_plainly(events)
    assert chat.folded(log.limit(0), ["turn"]).count() == 0


def test_messages_told_anew_after_a_regenerate_stay(spark):
    events = [
        (1, 1, "message", 1, "user", "q"), (1, 3, "message", 2, "assistant", "a"), (1, 5, "message", 3, "user", "old"),
        (1, 6, "regenerate", 2, None, None), (1, 7, "delta", 2, None, "b"), (1, 8, "message", 3, "user", "new"),
        (1, 9, "delta", 3, None, "er"), (2, 1, "message", 1, "user", "q"), (2, 2, "message", 2, "assistant", "gone"),
        (2, 3, "regenerate", 1, None, None),
    ]
    log = spark.createDataFrame(events, "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string")
    found = chat.folded(log, ["turn"]).select("conv_id", "turn", "role", "text").collect()
    assert Counter(map(tuple, found)) == Counter(
        [(1, 1, "user", "q"), (1, 2, "assistant", "b"), (1, 3, "user", "newer"), (2, 1, "user", "")])


def test_nested_regenerates(spark):
    events = [
        (1, 1, "message", 1, "user", "q"), (1, 2, "message", 2, "assistant", "a"), (1, 3, "message", 3, "user", "b"),
        (1, 4, "message", 4, "assistant", "c"), (1, 5, "regenerate", 3, None, None), (1, 6, "message", 4, None, "again"),
        (1, 7, "regenerate", 2, "assistant", None), (1, 8, "delta", 3, None, "later"), (1, 9, "delta", 2, None, "new"),
    ]
    log = spark.createDataFrame(events, "conv_id bigint, seq bigint, kind string, turn bigint, role string, text string")
    found = chat.folded(log, ["turn"]).select("conv_id", "turn", "role", "text").collect()
    want = Counter([(1, 1, "user", "q"), (1, 2, "assistant", "new"), (1, 3, "", "later")])
    assert Counter(map(tuple, found)) == want == fold_plainly(events)
