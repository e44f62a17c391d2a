"""Chat formatting, URL rules and token counts: edge cases and brute force."""

import hashlib
import random

import pytest
from oracle import compare, duck

from strata.llm import bpe_count, chat_format, url_rules

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, conv string"


def _back(spark, rows):
    df = spark.createDataFrame(rows, TURNS)
    return {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}


def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(1)
    bits = ["\\", "\n", "a", " ", "é", *chat_format.CONTROL, chat_format.OPEN, chat_format.ROLE_END, chat_format.TURN, chat_format.CLOSE]
    rows, want = [], {}
    for conv in range(60):
        turns = [
            (t, rng.choice(["user", "assistant", "\\", "x [/ROLE]\ny", ""]), "".join(rng.choices(bits, k=rng.randrange(8))))
            for t in range(rng.randrange(1, 9))
        ]
        want[conv] = [(r, x) for _, r, x in turns]
        rows += [(conv, t, r, x, "extra") for t, r, x in turns]
    rng.shuffle(rows)
    got = _back(spark, rows)
    assert {k: [tuple(t) for t in v.turns] for k, v in got.items()} == want


def test_chat_nulls_ties_merges_and_empty(spark):
    rows = [
        (1, 2, "user", None, None), (1, 2, "user", None, None), (1, None, None, "first", None),
        (1, 3, "user", "b", None), (None, 1, "assistant", "x", None),
    ]
    got = _back(spark, rows)
    assert [tuple(t) for t in got[1].turns] == [("", "first"), ("user", ""), ("user", ""), ("user", "b")]
    assert got[1].formatted.count("[ROLE]") == 2  # three user turns, one block
    assert [tuple(t) for t in got[None].turns] == [("assistant", "x")]
    assert _back(spark, []) == {}


def test_chat_very_long_conversation(spark):
    rows = [(5, t, "user" if t % 3 else "assistant", "w" * 50, None) for t in range(2000)]
    got = _back(spark, rows)[5]
    assert [t.text for t in got.turns] == ["w" * 50] * 2000


def test_chat_query(spark):
    ok, why = compare(chat_format.op7_chat_format(spark, SMALL), duck(SMALL), chat_format.OP7_SQL)
    assert ok, why
    row = chat_format.op7_chat_format(spark, SMALL).where(f"conv_id = {chat_format.HOSTILE_ID}").first()
    text = chat_format.HOSTILE_TEXT
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


URLS = "page_id long, url string, host string, key string"


def _judge(spark, urls, rules, default="allow"):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)]
    out = url_rules.judge_urls(spark.createDataFrame(rows, URLS), "page_id", "url", rules, default).collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(out, key=lambda r: r.page_id)]


def test_url_edges(spark):
    got = _judge(
        spark,
        [None, "", "nothing", "http://", "HTTP://A.Example.NET/en/x?q#f", "https://net", "http://xnet/", "http://b.net/é#/en/", "http://É.net:80/"],
        url_rules.RULES,
    )
    assert got[:4] == [("", "", None, "allow")] * 4
    assert got[4] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5] == ("net", "", None, "allow")  # no path: the rule's path "/" does not fit
    assert got[6] == ("xnet", "/", None, "allow")
    assert got[7] == ("b.net", "/é", "net/", "block")
    assert got[8] == ("É.net:80", "/", None, "allow")
    assert _judge(spark, [], url_rules.RULES) == []


def test_url_brute_force(spark):
    rng = random.Random(3)
    labels = ["a", "b", "a-b", "c"]
    host = lambda: ".".join(rng.choices(labels, k=rng.randrange(1, 4)))
    path = lambda: "/" + "/".join(rng.choices(["x", "y", "xy"], k=rng.randrange(0, 3)))
    rules = list({(h := host(), p := path()): (rng.choice(["allow", "block"]), h, p) for _ in range(40)}.values())
    urls = [f"http://{host()}{path()}" for _ in range(400)]

    def best(u):
        h, _, p = u[7:].partition("/")
        fits = [r for r in rules if (h == r[1] or h.endswith("." + r[1])) and ("/" + p).startswith(r[2])]
        r = max(fits, key=lambda r: (len(r[1]) + len(r[2]), len(r[1])), default=None)
        return (r[1] + r[2], r[0]) if r else (None, "block")

    assert [x[2:] for x in _judge(spark, urls, rules, "block")] == [best(u) for u in urls]


def test_url_query(spark):
    ok, why = compare(url_rules.op9_url_rules(spark, SMALL), duck(SMALL), url_rules.OP9_SQL)
    assert ok, why
    with pytest.raises(ValueError):
        url_rules.Sweep([("maybe", "net", "/")])


def test_token_counts_match_the_tokenizer_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "n_chars")
    rng = random.Random(5)
    alphabet = list("aeiou thrs'\n\t.,!?0123456789éßñ 漢字🙂") + ["<|endoftext|>", "  ", "'ll", "­"]
    extra = [(-1 - i, "".join(rng.choices(alphabet, k=rng.randrange(300))), 0) for i in range(200)]
    extra += [(-500, None, 0), (-501, "", 0), (-502, "ab" * 30000, 0), (-503, " " * 5000, 0), (-503, " " * 5000, 0)]
    both = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string, n_chars long"))
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    for r in bpe_count.count_tokens(both, path).collect():
        text = texts[r.doc_id]
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024), r
    assert bpe_count.count_tokens(both.limit(0), path).count() == 0


def test_token_memory_is_bounded(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe_count, "MEMORY_WORDS", 4)
    c = bpe_count.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    words = [f" w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    n = [c.tokens_of_text(w) for w in words + words]
    assert n[:200] == n[200:] and len(c.seen) <= 4


def test_rules_as_a_table_judge_alike(spark):
    rng = random.Random(4)
    labels = ["net", "com", "org", "example", "a", "b", ""]
    rules = [(rng.choice(["allow", "block"]), ".".join(rng.choices(labels[:-1], k=rng.randrange(1, 4))), "/" + "x/" * rng.randrange(3)) for _ in range(40)]
    urls = [(i, "http://" + ".".join(rng.choices(labels, k=rng.randrange(1, 5))) + "/" + "x/" * rng.randrange(4) + rng.choice(["", "?q", "#f"])) for i in range(400)]
    urls += [(None, None), (1, "no scheme"), (1, "no scheme"), (2, "http://" + "a." * 500 + "net/" + "x/" * 500)]
    df = spark.createDataFrame(urls, "page_id long, url string")
    swept = url_rules.judge_urls(df, "page_id", "url", rules)
    joined = url_rules.judge_urls_by_table(df, "page_id", "url", spark.createDataFrame(rules, "action string, host string, path string"))
    assert sorted(map(repr, swept.collect())) == sorted(map(repr, joined.collect()))
