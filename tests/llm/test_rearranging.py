"""Fill-in-middle, conversation repair and URL filters against plain Python and SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from martkit.llm import conversation_repair as repair, fill_middle as fim, url_filter as urls
from martkit.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def same_as_sql(spark, name, tables):
    mine = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rows = con.execute(ORACLES[name]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(mine.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, mine.select(*names).collect()))) == sorted(map(repr, rows)) and rows


# --- fill in the middle


def plain_fill(key, text):
    """The contract, word for word."""
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = sha(f"42:{'' if key is None else key}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(t) for t in (tokens[:x], tokens[x:y], tokens[y:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    made = ["", None, " ", "\n\n", "a", " a", "a ", "ü ß\u2003x", "<P>", "a <S> b", "<M", "S> x <", "<", ">", "a<P", "P>b", "\x0b\x0c\r\t x", "\x1c\x85 y"]
    rng = random.Random(5)
    made += ["".join(rng.choice("ab é\n\t<>PSM漢") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    return [(k, t) for k, t in enumerate(made)] + [(None, "no key at all here"), (-3, "a b c d"), (-3, "a b c d"), (10**12, "w " * 200_000)]


def test_fill_in_middle(spark, docs):
    rows = odd_texts()
    out = fim.fill_in_middle(docs(rows, clash=True))
    want = sorted(repr((k, *plain_fill(k, t))) for k, t in rows)
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in out.collect()) == want
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    back = fim.restore_texts(out)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((k, t or "")) for k, t in rows)
    digests = fim.fill_digests(docs(rows)).collect()
    assert sorted(repr((r.doc_id, r.output_sha256, r.restored_sha256)) for r in digests) == sorted(repr((k, sha(plain_fill(k, t)[-1]), sha(t or ""))) for k, t in rows)
    assert fim.fill_in_middle(docs([])).count() == 0 and fim.restore_texts(fim.fill_in_middle(docs([]))).count() == 0


def test_fill_in_middle_refuses_a_broken_output():
    step = fim.Step.of([b"<S>a<P>b", b"<S>a<P>b<M>c<M>"])
    with pytest.raises(ValueError, match="each mark once"):
        fim.put_back(step, fim.np.array([fim.SPM, fim.SPM]))


def test_fill_in_middle_query(spark):
    same_as_sql(spark, "op11_fill_middle", ["documents"])


# --- conversations


def cheapest_by_force(codes):
    """Shortest ways by plain relaxation over (row, state); the least edits among the cheapest."""
    best = {(0, repair.START): (0, "")}
    nexts = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    changed = True
    while changed:
        changed = False
        for (i, state), (cost, edits) in list(best.items()):
            ways = [(5, "I", i, nexts[state][c]) for c in "ua" if c in nexts[state]]
            if i < len(codes):
                initial, goes, truncated = codes[i]
                ways.append((2, "D", i + 1, state))
                if not goes:
                    more = 5 if truncated else 0
                    if initial in nexts[state]:
                        ways.append((more, "K", i + 1, nexts[state][initial]))
                    ways += [(1 + more, "R", i + 1, nexts[state][c]) for c in "ua" if c in nexts[state]]
            for c, letter, j, to in ways:
                new = (cost + c, edits + letter)
                if (j, to) not in best or new < best[j, to]:
                    best[j, to] = new
                    changed = True
    return min(best[len(codes), s] for s in (0, 3) if (len(codes), s) in best)


def codes_of(rng, n):
    return tuple((rng.choice("suuaa "), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n))


def test_search_finds_the_cheapest_edits():
    rng = random.Random(7)
    for _ in range(400):
        codes = codes_of(rng, rng.randint(0, 9))
        codes = tuple((c, g, t and not g) for c, g, t in codes)
        assert repair.cheapest(codes) == cheapest_by_force(codes)
        cuts = sorted(rng.randint(0, len(codes)) for _ in range(rng.randint(0, 3)))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)], strict=True)]
        assert repair.put_together([repair.moves(p) for p in parts]) == cheapest_by_force(codes)


def plain_report(rows):
    """The contract, row by row, over ``(conv, turn, role, text)``."""
    ids = {r[0] for r in rows}
    after = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv in ids:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, codes, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            letters = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not letters else 1 if (role, text) in seen else 2 if letters[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            codes.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        known = [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = cheapest_by_force(codes)
        state, said, rest = 0, [], iter(own)
        for edit in audit:
            wanted = "assistant" if state == 2 else "user"
            row = next(rest) if edit != "I" else None
            if edit == "D":
                continue
            role, text = (wanted, "") if edit == "I" else (row[2], row[3]) if edit == "K" else (wanted, row[3])
            said.append(f"{role}:{text}")
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(said)))
    return out


def odd_conversations():
    rng = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "Why?", "  ", "", None, "No way", "So it is!\n", "Ah…", "Yes. "])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(["user", "assistant", "system", "User", "", None, "unit"]), text))
    rows += rows[:40]
    # A long one, with a turn that very many rows share.
    rows += [(1000, k, "user" if k % 2 == 0 else "assistant", f"Line {k % 50}.") for k in range(160)]
    rows += [(1001, 4, "user", "Same.")] * 130
    return rows


def conversations(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], "conv_id long, turn long, role string, text string, kind string, copies string")


def collected(report):
    return {r.conv_id: tuple(r)[1:] for r in report.collect()}


@pytest.mark.parametrize("block,partitions", [(48, 8), (3, 30)])
def test_repair_of_odd_conversations(spark, monkeypatch, block, partitions):
    rows = odd_conversations()
    monkeypatch.setattr(repair, "BLOCK", block)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = collected(repair.repair_report(repair.damaged(conversations(spark, rows))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = plain_report(rows)
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_repaired_rows(spark):
    rows = conversations(spark, [(1, 0, "user", "Hi."), (1, 1, "user", "Well"), (1, 2, "assistant", "Good."), (2, 0, "assistant", " "), (None, 1, "system", "Be kind.")])
    got = sorted(repr(tuple(r)) for r in repair.repair(repair.turns(rows)).collect())
    assert got == sorted(map(repr, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Good.")]))
    assert repair.repair_report(repair.damaged(rows.limit(0))).count() == 0 and repair.repair(repair.turns(rows.limit(0))).count() == 0


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op12_conversation_repair"](spark, SF)) == plain_report(rows)


# --- URLs


def plain_judge(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match("[^/?#]*", rest)[0])
        path = re.match("[^?#]*", rest[len(host) :])[0]
    fitting = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fitting:
        rule = max(fitting, key=lambda r: len(r.name))
        return host, path, rule.name, "allow" if rule.allow else "block"
    return host, path, None, "block" if url in listed else "allow"


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http:///x", "HTTP://WWW.Example.ORG/es/1", "http://example.org", "http://example.org/en/15", "http://notexample.org/en/15",
    "http://org/x", "http://a.com/fr/x?y#z", "http://a.com/de/#x", "http://a.com/de", "http://a.com?/fr/", "http://a.net#://b.com/de/", "http://É.org/", "http://a.org:80/x",
    "x://y://z", "http://a.net/é/漢", "http://user@a.com/de/x", "//a.com/de/", "http://a.net/p/" + "x" * 100_000,
]


def test_rules_and_list(spark):
    listed_odd = {"http://a.net/é/漢", "http:///x", "x://y://z"}
    rows = [(k, u, None) for k, u in enumerate(ODD_URLS)] + [(None, "http://a.com/de/1", None), (3, "http://a.com/de/1", None), (3, "http://a.com/de/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, canonical string")
    given = spark.createDataFrame([(u,) for u in [*listed_odd, *listed_odd, None]], "u string").select(urls.canonical(F.col("u")).alias("canonical"))
    for blocks in (urls.BLOCKS, 1):
        got = urls.judge_urls(pages, given, blocks=blocks)
        assert sorted(repr(tuple(r)[:5]) for r in got.collect()) == sorted(repr((k, *plain_judge(u, listed_odd))) for k, u, _ in rows)
    assert {r.verdict for r in urls.judge_urls(pages.filter("url LIKE '%漢'"), given.limit(0)).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0), given).count() == 0
    kept = urls.drop_blocked(pages, given)
    assert sorted(repr(r.url) for r in kept.collect()) == sorted(repr(u) for _, u, _ in rows if plain_judge(u, listed_odd)[3] == "allow")
    assert kept.columns == pages.columns


def test_canonical_forms(spark):
    same = ["http://A.net:80/x/?utm_source=f&b=2&a=1#top", "https://a.net/x?a=1&b=2", "https://a.net:443/x/?b=2&a=1&ref=q"]
    rows = spark.createDataFrame([(u,) for u in [*same, "nothing", None]], "u string").select(urls.canonical(F.col("u")).alias("c")).collect()
    assert [r.c for r in rows] == ["a.net/x?a=1&b=2"] * 3 + [None, None]


def test_filter_of_fixed_size_passes_every_listed_url(spark):
    many = spark.range(3_000).select(F.concat(F.lit("h.net/"), "id").alias("canonical"))
    pages = spark.range(6_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.net/"), "id").alias("url"))
    for blocks in (1 << 10, 4):
        assert urls.bloom_filter(many, blocks).count() <= blocks
        assert urls.judge_urls(pages, many, [], blocks=blocks).filter((F.col("verdict") == "block") != (F.col("page_id") < 3_000)).count() == 0
    with pytest.raises(ValueError, match="rules"):
        urls.rule_for(F.lit("a"), F.lit("b"), urls.RULES * 300)


def test_url_query(spark):
    same_as_sql(spark, "op13_url_filter", ["pages"])
    assert "Python" not in QUERIES["op13_url_filter"](spark, SF)._jdf.queryExecution().toString()
