from collections import defaultdict

from hearth.llm import chat_format as C
from hearth.llm import line_dedup as L

PAGE = "<html><head><title>{t}</title><style>p{{x}}</style></head><body><nav><a href='/'>Home</a></nav><p>{b}<br>two  <b>bold</b></p><!-- no --><footer>Imprint</footer></body></html>"


def test_lines_of_html(spark):
    df = spark.createDataFrame([(PAGE.format(t="T", b="one"),), (None,), ("plain\ntext",), ("<script>if (a<b) {}</script >x<P CLASS='a'>y",)], "h string")
    got = [r[0] for r in df.select(L.html_lines(df["h"])).collect()]
    assert got == [["T", "Home", "one", "two bold", "Imprint"], [], ["plain text"], ["x", "y"]]


def test_hosts(spark):
    urls = ["http://A.example.com/x", "https://u:p@b.org:8080/?q", "ftp://c", "nonsense", None, "http://?x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    assert [r[1] for r in df.select("i", L.host_of(df["u"])).sort("i").collect()] == ["a.example.com", "b.org", "c", None, None, None]


def brute_pages(pages, ratio, least):
    by = defaultdict(list)
    for _, host, lines in pages:
        by[host].append(set(lines))
    out = []
    for i, host, lines in pages:
        sets = by[host]
        gone = {s for s in set(lines) if host is not None and (n := sum(s in x for x in sets)) >= least and n > ratio * len(sets)}
        out.append((i, host, len(lines), sum(s in gone for s in lines), "\n".join(s for s in lines if s not in gone)))
    return sorted(out, key=str)


def test_boilerplate_matches_brute_force(spark):
    pages = []
    for i in range(60):
        host = ["hot.com", "hot.com", "b.org", "c.net"][i % 4]
        lines = ["Menu", f"body {i}", "Menu" if i % 7 == 0 else f"more {i % 5}", "Imprint" if i % 3 else f"x{i}"]
        pages.append((i, host, lines))
    pages += [(100, "one.com", ["Menu", "a"]), (101, None, ["Menu"]), (102, None, ["Menu"]), (103, None, ["Menu"]), (104, "hot.com", []), (5, "hot.com", ["Menu", "body 5"]), (5, "hot.com", ["Menu", "body 5"])]
    rows = [(i, None if h is None else f"http://{h}/{k}", "<p>".join(ls) if ls else None, "e", "h") for k, (i, h, ls) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, lines string, host string")
    got = sorted((tuple(r) for r in L.drop_boilerplate(df, max_ratio=0.3, min_pages=3).collect()), key=str)
    assert got == brute_pages(pages, 0.3, 3)
    assert sum(r[3] for r in got) > 50


def test_pages_empty_table(spark):
    assert L.drop_boilerplate(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_chats(rows):
    convs = defaultdict(set)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].add((turn, role, text))
    order = lambda t: tuple((x is None, x) if x is not None else (True, 0) for x in t)
    seqs = {c: [(r, x) for _, r, x in sorted(ts, key=order)] for c, ts in convs.items()}
    out = {}
    for c, s in seqs.items():
        longer = any(len(o) > len(s) and o[: len(s)] == s for o in seqs.values())
        same = [o for o, t in seqs.items() if t == s]
        if not longer and c == min(same):
            out[c] = (len(s), len(same), "".join(f"<|{r or 'unknown'}|>\n{x or ''}\n<|end|>\n" for r, x in s))
    return out


def chat_rows():
    rows = []
    for c in range(12):  # snapshots of three dialogues that share their first turn
        n = 1 + c % 5
        rows += [(c, t, ["user", "assistant"][t % 2], "hello" if t == 0 else f"d{c % 3} t{t}") for t in range(n)]
    rows += [(20, t, "user", f"long {t}") for t in range(2500)] + [(21, t, "user", f"long {t}") for t in range(1500)]
    rows += [(30, None, None, None), (30, 1, "user", None), (30, 1, "user", None), (31, 1, "user", ""), (None, 1, "user", "lost"), (32, 1, "user", "b"), (32, 1, "user", "a"), (33, 7, "user", "a")]
    return rows


def test_chats_match_brute_force(spark, monkeypatch):
    df = spark.createDataFrame([(*r, "x") for r in chat_rows()], "conv_id long, turn long, role string, text string, pos string")
    got = {r["conv_id"]: (r["n_turns"], r["copies"], r["chat"]) for r in C.format_chats(df).collect()}
    assert got == brute_chats(chat_rows())
    monkeypatch.setattr(C, "CHUNK", 2)
    monkeypatch.setattr(C, "PART", 1000)
    parts = defaultdict(list)
    for r in sorted(C.format_chats(df).collect(), key=lambda r: (r["conv_id"], r["part"])):
        parts[r["conv_id"]].append(r["chat"])
    assert {c: "".join(p) for c, p in parts.items()} == {c: v[2] for c, v in brute_chats(chat_rows()).items()}
    assert len(parts[20]) == 3


def test_chats_empty_table(spark):
    assert C.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
