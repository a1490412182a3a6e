import hashlib
import html as H
import re

from clickflow.llm import op1_lineblocks as X, op5_templates as T, op7_qgrams as Q, op8_chat as C

from .conftest import EDGE, SF

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x="</p>";</script><style>p{}</style></head>
<body class="has-sidebar"><header><a href="/">Site</a> name</header><nav><ul><li><a href="/a">Menu one</a><li><a>two</a></ul></nav>
<div class="cookie-notice">We use cookies for a very long list of reasons that no one reads, ever, at all, so this is long.</div>
<main><article><header><h1>The &amp; title</h1></header><p>First   <b>bold</b>
 line &eacute;&#233;&nbsp;x.<p>Unclosed <i>para</i>graph<!-- hidden > comment --> goes on.<div class="ad-slot">Buy now</div>
<ul><li>item 1</li><li>item 2</li></ul><form><input><label>Name</label><button>Send</button></form><p><a href="x">all link</a></p>
<aside>Related stuff</aside><p>Of.</p><blockquote>Quote a&lt;b</blockquote><div hidden>secret</div></article>
<section id="comments"><p>A reader comment that is quite long and would count as text if it were not excluded here.</p></section></main>
<div class="sidebar">Side</div><footer>&copy; Site</footer></body></html>"""


def test_page_parts():
    assert X.main_text(PAGE) == ("The & title First bold line éé x. Unclosed paragraph goes on. item 1 item 2 all link Of. "
                                 "Quote a<b")


def test_unmarked_pages_by_line_blocks():
    long = "some words of a paragraph that go on for more than eighty characters so that the sum of the window surges"
    links = "".join(f'<li><a href="{i}">a link text that is as long as a line {i}</a></li>' for i in range(9))
    page = f"<body><ul>{links}</ul><div>{long}</div><p>short</p><p>{long} 2</p><ul>{links}</ul><p>stray</p><ul>{links}</ul></body>"
    assert X.main_text(page) == f"{long} short {long} 2"
    assert X.main_text("<p>tiny</p>") == "tiny"


def test_implied_end_tags_and_names():
    assert X.main_text('<article><p class="notice">x<p>Real text</article>') == "Real text"
    assert X.main_text('<article><ul><li class="share">x<li>Real</ul>text</article>') == "Real text"
    assert X.main_text('<article><dl><dt class="ad">x<dd>Real</dl><table><tr><td class="promo">y<td>text<tr><td>more</table>'
                       "<p>end</article>") == "Real text more end"
    assert X.main_text('<article><p class="ad">x<span>y</span><div>Real</div><ul><li>a<ul><li class="ad">b</ul><li>c</ul></article>'
                       ) == "Real a c"
    for name in ("sidebar-content", "footer-text", "main-menu", "cookie-content", "entry-footer"):
        assert X.main_text(f'<article><p>Real text</p><div class="{name}">junk <p>more junk</p></div></article>') == "Real text"
    page = '<div class="content has-sidebar"><p>' + "word " * 40 + "</p></div><p>short one</p>"
    assert X.main_text(page) == ("word " * 40 + "short one")


def test_broken_pages():
    assert X.main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert X.main_text("<article>a<p title='x > y'>b</p><br>c <a href=\"") == "a b c"
    assert X.main_text("") == X.main_text(None) == X.main_text("<nav>x</nav>") == ""
    assert X.main_text("plain text only") == "plain text only"
    assert X.main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"


def test_pages_table(spark, none):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r.page_id: r for r in X.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        want = " ".join(H.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert (out[r.page_id].url, out[r.page_id].text, out[r.page_id].n_chars) == (r.url, want, len(want))
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x"), (2, "u", "<p>" + "wörd " * 50000, "x")],
                                "page_id BIGINT, url STRING, html STRING, text STRING")
    assert sorted(r.n_chars for r in X.extract(odd).collect()) == [0, 0, 0, 249999]
    assert X.extract(odd.limit(0)).count() == 0


def blocks_brute(page):
    """An unmarked page of divs and links: text between the places where three lines together hold 80
    characters outside of links and where three lines hold none, found with a plain tokenizer."""
    lines = []
    for div in re.findall(r"<div>(.*?)</div>", page, re.S):
        text = " ".join(H.unescape(re.sub(r"<[^>]*>", "", div)).split())
        linked = sum(len(" ".join(H.unescape(a).split())) for a in re.findall(r"<a>(.*?)</a>", div))
        if text:
            lines.append((text, len(text) - linked))
    out, i = [], 0
    stretches = []
    while i < len(lines):
        if lines[i][1] == 0:
            i += 1
            continue
        j = i
        while j < len(lines) and sum(w for _, w in lines[j: j + 3]):
            j += 1
        stretches.append((i, j))
        i = j
    big = [(i, j) for i, j in stretches if any(sum(w for _, w in lines[k: k + 3]) >= 80 for k in range(i, j))]
    if not big and stretches:
        big = [max(stretches, key=lambda x: sum(w for _, w in lines[x[0]: x[1]]))]
    for i, j in big:
        out += [t for t, _ in lines[i:j]]
    return " ".join(out)


def test_line_blocks_equal_brute_force():
    import random
    rng = random.Random(6)
    for _ in range(400):
        divs = []
        for _ in range(rng.randint(1, 25)):
            words = " ".join(rng.choice(["a", "word", "some&amp;more", "text"]) for _ in range(rng.choice([1, 2, 5, 30])))
            divs.append(f"<div>{rng.choice([words, words, f'<a>{words}</a>', f'<a>{words}</a>', ''])}</div>")
        page = "<body>" + "".join(divs) + "</body>"
        assert X.main_text(page) == blocks_brute(page), page


def lines_brute(rows, min_docs):
    """Recurring templates counted line by line, keys as token tuples."""
    keys, docs = {}, dict.fromkeys(rows)
    for rid in docs:
        text = rid[1] or ""
        sig = signature(text)
        for i, line in enumerate(text.split("\n")):
            t = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in re.findall(r"[^\x20\x09-\x0D]+", line)]
            t = ["<*>" if re.search("[0-9]", x) else x for x in t]
            n = len(t)
            mine = [(n, tuple(t))] if n >= 3 else []
            for j in range(3 if n >= 8 else 0):
                mine.append((n, j, tuple("<?>" if p >= 2 and (p - 2) * 3 // (n - 2) == j else x for p, x in enumerate(t))))
            for k in mine:
                keys.setdefault(k, []).append((rid, sig, i))
    drop = {}
    for uses in keys.values():
        n_docs, n_sigs = len({u[0] for u in uses}), len({u[1] for u in uses})
        if n_sigs >= min_docs + 0.2 * n_docs:
            for rid, _, i in uses:
                drop.setdefault(rid, set()).add(i)
    return {rid: "\n".join(x for i, x in enumerate(rid[1].split("\n")) if i not in drop.get(rid, ())) if rid[1] is not None
            else None for rid in docs}


def signature(text):
    import numpy as np
    from clickflow.llm.common import shingles, words
    data = np.frombuffer(text.encode(), np.uint8)
    row, _, _, h = words(data, np.array([0, len(data)]))
    return int(shingles(row, h, 1, 2)[1].min()) if len(h) else None


def test_lines_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for min_docs in (4, 20):
        want = lines_brute(rows, min_docs)
        out = T.drop_templates(docs, min_docs=min_docs).collect()
        assert {(r.doc_id, want[r.doc_id, t]) for r, t in ((r, dict(rows)[r.doc_id]) for r in out)} == {
            (r.doc_id, r.text) for r in out}
        assert (min_docs > 4 or any(r.n_dropped for r in out)) and all(r.n_chars == len(r.text) for r in out)


def test_templates_generalise_and_copies_do_not_count(spark):
    import random
    rng = random.Random(1)
    body = lambda: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10 ** 6)}x" for _ in range(40)) + " unique text here"
    rows = [(i, f"{body()}\nPage {i} of {i * 7} printed on 2020-01-{i}\nshared by the reader named {rng.choice('pqrstuv')}{'z' * (i % 9)} "
                f"on our little site today\n\nok", "x") for i in range(60)]
    copy = f"{body()}\nthis line stands in each of the many copies of one text"
    rows += [(100 + i, copy + (f" {i}" if i % 50 == 0 else ""), "x") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, extra STRING").repartition(3)
    out = {r.doc_id: r.text for r in T.drop_templates(df).collect()}
    assert all(out[i].count("\n") == 2 and out[i].endswith("\n\nok") and "unique text" in out[i] for i in range(60))
    assert all("copies of one text" in out[100 + i] for i in range(400))


def test_templates_of_hot_copies_near_copies_and_long_passages(spark):
    import random
    rng = random.Random(2)
    body = lambda n: [f"{''.join(rng.choices('abcdefghij', k=9))}" for _ in range(n)]
    notice, passage = "a notice that stands in many texts", " ".join(body(90))
    one = " ".join(body(40))
    rows = [(i, " ".join(body(40)) + "\n" + notice) for i in range(40)]
    rows += [(1000 + i, f"{one}\n{notice}") for i in range(600)]  # copies of one of them
    rows += [(2000 + i, " ".join(body(12)) + "\n" + passage) for i in range(12)]  # a long passage in short texts
    near = [body(10) for _ in range(20)]
    for i in range(400):  # near copies, a line of each an edited one
        lines = [list(x) for x in near]
        lines[rng.randrange(20)] = body(10)
        rows.append((3000 + i, "\n".join(map(" ".join, lines))))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    out = {r.doc_id: r.text for r in T.drop_templates(df).collect()}
    for d, t in rows:
        assert out[d] == (t if d >= 3000 else t.split("\n")[0]), d


def test_line_edges(spark, edge, none):
    out = T.drop_templates(edge).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in out) == sorted((d or -1, t or "") for d, t, *_ in EDGE)
    assert sum(r.text is None for r in out) == 2 and set(edge.columns) <= set(T.drop_templates(edge).columns)
    assert T.drop_templates(none).count() == 0
    own = [" ".join("".join(chr(97 + int(c)) for c in f"{i:02}{j:02}") for j in range(30)) for i in range(40)]
    one = spark.createDataFrame([(i, f"{w}\nthe very same line") for i, w in enumerate(own)], "doc_id BIGINT, text STRING")
    only = spark.createDataFrame([(i, "the very same line") for i in range(40)], "doc_id BIGINT, text STRING")
    assert all(r.text == own[r.doc_id] for r in T.drop_templates(one).collect())
    assert all(r.n_dropped == 0 for r in T.drop_templates(only).collect())  # copies of one document


def distance(item: bytes, text: bytes):
    """The least edit distance of ``item`` to any region of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_matches_equal_brute_force(spark):
    import random
    rng = random.Random(4)
    syl = ["the", "an", "er", "in", "on", "st", "re", "ou", "ble", "th", " ", " ", " "]
    text = lambda n: "".join(rng.choice(syl) for _ in range(n))
    items = [(i, text(rng.choice([6, 11, 20, 40, 90]))) for i in range(12)] + [(90, None), (91, "short"), (92, "")]
    rows = []
    for d in range(90):
        t, i = text(200), items[d % 12][1]
        edits = rng.choice([0, 0, 1, 2, 4, 7, 12])
        for _ in range(edits):
            k = rng.randrange(len(i))
            i = i[:k] + rng.choice(["", "q", i[k] + "w"]) + i[k + 1:]
        k = rng.randrange(len(t))
        rows.append((d, t[:k] + (i.upper() if d % 3 else i) + t[k:] if d % 4 else t))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(2)
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    want = {}
    plain = lambda t: Q.reduced([t])[0].tobytes().rstrip(b" ")
    for d, t in rows:
        buf = plain(t)
        for i, item in items:
            word = plain(item)
            if len(word) >= 10:
                n = distance(word, buf)
                if n <= int(0.08 * len(word)):
                    want[d, i] = n
    for block in (Q.BLOCK_CHARS, 300):
        out = Q.matches(df, bench, block_chars=block).collect()
        assert {(r.doc_id, r.item_id): r.distance for r in out} == want and len(out) == len(want)
        free = Q.free_rows(df.withColumn("item_id", df.text), bench, block_chars=block)
        assert free.columns == ["doc_id", "text", "item_id"]
        assert sorted(r.doc_id for r in free.collect()) == sorted({d for d, _ in rows} - {d for d, _ in want})
    assert len(want) > 30 and len(set(want.values())) > 2


def test_long_item_beside_a_short_one(spark):
    """What is found of an item near its budget doesn't depend on the items that share its index."""
    import random
    rng = random.Random(8)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1000))
    edited = list(word)
    for i in range(12, 1000, 100):  # eighty edits in clusters, so that the common grams lie unevenly
        for j in range(8):
            edited[i + j * 7] = "9"
    item = [(1, word), (2, "".join(rng.choice("zyxwvut") for _ in range(40)))]
    docs = spark.createDataFrame([(5, f"before it {''.join(edited)} after it")], "doc_id BIGINT, text STRING")
    for items in (item[:1], item):
        out = Q.matches(docs, spark.createDataFrame(items, "item_id BIGINT, text STRING")).collect()
        assert [(r.doc_id, r.item_id, r.distance) for r in out] == [(5, 1, 80)]


def test_repetitive_texts_need_bounded_memory():
    import resource
    import numpy as np
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    index = Q.Items([1], ["ab" * 300])
    buf, off = Q.reduced(["x " + "ab" * 100_000])
    found = index.candidates(buf, off)
    assert len(found) and (found[:, 1] == 0).all()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 800_000  # kB
    run = Q._matcher(type("Held", (), {"value": [index]}))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array(["x " + "ab" * 100_000])], ["doc_id", "text"])
    assert [tuple(r.values()) for r in next(iter(run(iter([batch])))).to_pylist()] == [(7, 1, 2, 600, 0)]


def test_exact_passages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = bench.collect()
    want = {(r.doc_id, i.item_id) for r in docs.select("doc_id", "text").collect() for i in items if i.text in r.text}
    assert {(r.doc_id, r.item_id) for r in Q.matches(docs, bench).collect()} == want and want


def test_match_edges(spark, edge, none):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog the quick", "y"), (None, None, None), (2, "", "z")],
                                  "item_id BIGINT, text STRING, doc_id STRING")
    assert [(r.doc_id, r.item_id, r.distance) for r in Q.matches(edge, bench).collect()] == [(7, 1, 0)]
    assert Q.matches(none, bench).count() == 0 and Q.matches(edge, bench.limit(0)).count() == 0


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_chat_round_trip(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in conv.select("conv_id", "turn", "role", "text").collect()]
    odd = [(1000, 0, "system", None), (1000, 1, "assistant", "<\\|im_end|> <|im_start|>user\nx <\\\\|"), (1000, 1, None, ""),
           (1001, 5, "we<|ird\nro\\le", "a"), (1001, 5, "we<|ird\nro\\le", "a"), (None, 0, "assistant", "qzprobe é😀"),
           (1002, None, "assistant", "first")]
    df = spark.createDataFrame(rows + odd, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    want = {}
    key = lambda v: (v is not None, v if v is not None else 0)
    for c, _, r, t in sorted(rows + odd + C.PROBE_ROWS, key=lambda x: (key(x[0]), key(x[1]), x[2] is not None, x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((r or "", t or ""))
    out = {r.conv_id: r for r in C.formatted_digests(df).collect()}
    assert set(out) == set(want)
    for c, turns in want.items():
        r = out[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests(turns), c
        assert r.formatted_chars == len(C.chat_template(turns)) and r.rewrites is None
    assert [r.conv_id for r in C.formatted_digests(df.limit(0)).collect()] == [-1]


def test_black_box_templates():
    turns = [("system", "be good"), ("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "no")]
    text, spans, rewrites = C.render(turns, lambda ts: "".join(f"[{r}] {t}</s>" for r, t in ts))
    assert rewrites is None and [text[a:b] for _, a, b, _, _ in spans] == [t for _, t in turns]
    assert [s[0] for s in spans] == [0] + [s[3] for s in spans[:-1]]

    def forgetful(ts):  # keeps only what follows the last user turn
        last = max((i for i, (r, _) in enumerate(ts) if r == "user"), default=0)
        return "".join(f"<{r}>{t}" for r, t in ts[last:])
    assert C.render(turns, forgetful)[2] == 1

    def closing(ts):  # a trailer after the last turn is rewritten by every further turn
        return "".join(f"<{r}>{t}" for r, t in ts) + "[end]"
    text, spans, rewrites = C.render(turns, closing)
    assert rewrites == 0 and [text[a:b] for _, a, b, _, _ in spans] == [t for _, t in turns]


def test_escapes_are_reversible():
    for t in ("<|", "<\\|", "<\\\\|x", "<<|>|", "<|im_end|>", "a<b|c", "\\<|"):
        assert C.unescape(C.escape(t)) == t and "<|" not in C.escape(t)
    assert C.parse(C.chat_template([("a\nb\\n", "<|im_start|>"), ("", "")])) == [("a\nb\\n", "<|im_start|>"), ("", "")]
