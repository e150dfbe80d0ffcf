"""URL filters, the filter audit and collocations against brute force, with their edge cases."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from itemrollup.llm import blocks as B
from itemrollup.llm import collocations as col
from itemrollup.llm import filter_audit as fa
from itemrollup.llm import queries, url_filter as uf
from itemrollup.llm.common import prepare
from itemrollup.llm.hat_trie import HatTrie, merge

U64 = np.uint64
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


# -- URL filters ---------------------------------------------------------------------------------


def as_regex(glob):
    out, at = "", 0
    while at < len(glob):
        c = glob[at]
        if c == "*" and glob[at:at + 2] == "**":
            out, at = out + "(?s:.*)", at + 1
        elif c == "*":
            out += "[^/?]*"
        elif c == "?":
            out += "(?s:.)"
        elif c == "\\":
            at += 1
            out += re.escape(glob[at])
        else:
            out += re.escape(c)
        at += 1
    return re.compile(out)


def test_glob_automaton_equals_regular_expressions():
    rng = random.Random(5)
    globs = ["", "*", "**", "a", "a*", "*a**b", "**/x/*", "a?c", "\\?\\*", "?é", "**a?**?/", "ab" * 40 + "*", "*.a.b/**"]
    globs += ["".join(rng.choice(["a", "b", "/", "?", "*", "**", "é", "."]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = ["", "a", "ab", "abc", "aéc", "?*", "é", "bé", "/x/y", "ab" * 40, "ab" * 41, "a" * 150, "a.b/x", "q.a.b/"]
    texts += ["".join(rng.choice("ab/?é.") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    buf, offs = B.buffers(pa.array(texts))
    automaton = uf.GlobAutomaton(globs)
    assert automaton.reads.shape[1] > 4
    want = np.array([[bool(as_regex(g).fullmatch(t)) for g in globs] for t in texts])
    for few in (0, 16, 10**6):  # all in lockstep, mixed, all one by one
        assert (automaton.run(buf, offs, few) == want).all()


def test_rules_decide_before_globs(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://a.example.com/en/1", "http://example.com/en", "x://com/",
        "x://com", "x://com?/", "x://xcom/", "x://a.net/es/1", "x://a.net/ES/1", "x://net/fr/", "x://a.net/de/", "x://poker.org/x", "x://poker.gov/x",
        "x://a.org/ads/1", "x://a.org/?u=/ads/", "x://a.org/f.exe", "x://a.org/f.exe?x", "x://a.org/f.exe#x", "x://q.net/x.com/", "x://y?z.com/",
        "a://b://net/es/", "x://" + "a" * 200_000 + ".net/fr/" + "b" * 200_000, "x://ÉÄ.net/es/", "x://a.net/es/1\nq", "x://a.net/es/1",
    ]
    pages = spark.createDataFrame([(i, u, "h", "clash", 1) for i, u in enumerate(urls)], "page_id bigint, url string, html string, verdict string, host int")

    def expect(url):
        if url is None or "://" not in url:
            host = path = query = ""
        else:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            query = re.match(r"(\?[^#]*)?", rest[len(host) + len(path):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        if fits:
            best = max(fits, key=lambda r: len(r.name))
            return host, path, best.name, None, best.verdict
        for globs, verdict in ((uf.ALLOW_GLOBS, "allow"), (uf.BLOCK_GLOBS, "block")):
            for g in globs:
                if as_regex(g).fullmatch(host + path + query):
                    return host, path, None, g, verdict
        return host, path, None, None, "allow"

    out = uf.filter_urls(pages)
    assert out.columns == ["page_id", "host", "path", "rule", "glob", "verdict"]
    got = {r["page_id"]: tuple(r)[1:] for r in out.collect()}
    assert got == {i: expect(u) for i, u in enumerate(urls)}
    assert uf.filter_urls(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in uf.filter_urls(pages, rules=[], block=["**"], allow=[]).collect()} == {"block"}
    assert {r["verdict"] for r in uf.filter_urls(pages, rules=[], block=[], allow=[], default="block").collect()} == {"block"}
    with pytest.raises(ValueError):
        uf.filter_urls(pages, rules=[uf.Rule("block", "a", "/x?")])


# -- filter audit --------------------------------------------------------------------------------


def brute_audit(counts, order):
    failed, out = 0, []
    for letter in order:
        bit = 1 << fa.FILTERS.index(letter)
        here = [c for m, c in counts.items() if m & bit and not m & failed]
        failed |= bit
        kept = sum(c[0] for m, c in counts.items() if not m & failed)
        out.append((kept, *(sum(c[i] for c in here) for i in range(3))))
    return out


def test_adjacent_swaps_reach_every_order():
    for n in range(1, 7):
        now = list(range(n))
        seen = [tuple(now)]
        for level in fa.adjacent_swaps(n):
            now[level], now[level + 1] = now[level + 1], now[level]
            seen.append(tuple(now))
        assert len(seen) == len(set(seen)) == len(list(itertools.permutations(range(n))))


def test_diagrams_equal_brute_force_in_every_order():
    rng = random.Random(2)
    for share in (0.0, 0.1, 0.5, 1.0):
        counts = {m: (rng.randint(1, 9), rng.randint(0, 3), rng.randint(0, 2)) for m in range(32) if rng.random() < share}
        shapley = collections.Counter()
        rows = fa.audit(counts)
        for order, step, kept, removed, redundant, alone, good, toxic, _ in rows:
            assert (kept, removed, good, toxic) == brute_audit(counts, order)[step - 1]
            bit = 1 << fa.FILTERS.index(order[step - 1])
            assert redundant == sum(c[0] for m, c in counts.items() if m & bit) - removed and alone == counts.get(bit, (0,))[0]
            shapley[order[step - 1]] += removed
        assert all(r[-1] == shapley[r[0][r[1] - 1]] for r in rows) and len(rows) == 600


def test_a_swap_keeps_equal_sub_diagrams_shared():
    full = fa.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(full.nodes) == 2 + 5  # the empty diagram, one leaf, one node a level
    full.swap(2)
    assert full.order == [0, 1, 3, 2, 4] and full.steps()[0][1:] == ((16, 0, 0), (16, 0, 0))
    assert fa.Diagram({0: (4, 1, 0)}, 5).nodes[1:] == [()]  # no filter fails: no node at all


def test_filter_audit_equals_brute_force_over_texts(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    say = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    texts = [None, "", " ", "A", say(250, vocab), say(250, vocab[:20]), say(300, vocab) + " #", "AB " * 300, "é" * 50 + "A", "x", "x"]
    texts += [say(rng.randint(1, 400), vocab) + rng.choice(["", "*", " ABC" * 40]) for _ in range(40)]
    rows = [(i, t, rng.choice(["s", "t", None, ""])) for i, t in enumerate(texts)] + [(60 + i, texts[4], "s") for i in range(9)]
    rows += [(61, texts[4], "t"), (4, texts[4], "s"), (None, texts[4], "s"), (None, "", None), (2, "x", "u")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 70, 2)] + [(4, 1, False), (4, 0, True), (None, 1, True), (999, 1, True)]
    docs = spark.createDataFrame([(*r, "c", 0) for r in rows], "doc_id bigint, text string, source string, mask string, n int").repartition(3)
    marks = spark.createDataFrame([(i, int(q), int(x)) for i, q, x in labels], "doc_id bigint, quality int, toxic int")

    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    counts = collections.defaultdict(dict)
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]]
        m = sum(f << k for k, f in enumerate(fails))
        good = any(q for j, q, _ in labels if j == i and i is not None)
        toxic = any(x for j, _, x in labels if j == i and i is not None)
        have = counts[s or ""].get(m, (0, 0, 0))
        counts[s or ""][m] = (have[0] + 1, have[1] + good, have[2] + toxic)
    out = fa.filter_audit(docs, marks)
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["good_lost"], r["toxic_lost"]) for r in out.collect()}
    want = {(p, "".join(o), k + 1): x for p, c in counts.items() for o in itertools.permutations(fa.FILTERS) for k, x in enumerate(brute_audit(c, o))}
    assert got == want
    assert fa.filter_audit(docs.limit(0), marks).count() == 0
    assert fa.filter_audit(docs, marks.limit(0)).count() == len(want)


def test_filter_audit_moves_no_raw_copies(spark):
    """The copies of a text are counted before they meet: the window gets counts, the join stored tables."""
    docs = spark.createDataFrame([(i, "same text", "s") for i in range(2000)], "doc_id bigint, text string, source string")
    out = {(r["filter_order"], r["step"]): r for r in fa.filter_audit(docs, spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int")).collect()}
    assert (out["EABCD", 1]["kept"], out["EABCD", 1]["removed"], out["EABCD", 2]["good_lost"]) == (1, 1999, 1)


# -- collocations --------------------------------------------------------------------------------


def random_run(rng, width, words, n):
    keys = np.array([[rng.choice(words) for _ in range(n)] for _ in range(width)], dtype=U64)
    order = np.lexsort(keys[::-1])
    return merge([(keys[:, order], np.ones(n, np.int64)), (keys[:, :0], np.empty(0, np.int64))])


@pytest.mark.parametrize("budget", [10, 300, 10**6])
def test_hat_trie_counts_like_a_dictionary(budget):
    rng = random.Random(budget)
    words = [0, 1, 2, 5, 2**63, 2**64 - 1, *(rng.randrange(2**64) for _ in range(30))]
    trie, want, got = HatTrie(3, capacity=16, budget=budget), collections.Counter(), collections.Counter()
    runs = []
    for _ in range(60):
        keys, n = random_run(rng, 3, words[:rng.choice([3, 36])], 40)
        want.update({tuple(k): int(c) for k, c in zip(keys.T.tolist(), n)})
        runs.extend(trie.add(keys, n))
    left = list(trie.drain())
    assert (len(runs) > 0) == (budget < 10**6)
    for keys, n in [*runs, *left]:
        found = [tuple(k) for k in keys.T.tolist()]
        assert found == sorted(set(found))  # a sorted run with one row a phrase
        for k, c in zip(found, n):
            got[k] += int(c)
    assert got == want
    assert [tuple(k) for keys, _ in left for k in keys.T.tolist()] == sorted(tuple(k) for keys, _ in left for k in keys.T.tolist())
    assert not list(trie.drain())


def brute_collocations(rows, least, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        best = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items())
            if not inside:
                score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(best)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(9)
    vocab = ["the", "of", "a", "é", "ü", "Zoë", "ab", "AB", "x" * 900, "x" * 901, "\u3042", "z\x00", *"bcdefg"]
    vocab += ["long-" + "".join(rng.choice("ab") for _ in range(700)) for _ in range(3)]
    rows = [(None, "en"), ("", None), (" .,;", "en"), ("a a a a a a a a", "en"), ("one", "de")]
    for _ in range(400):
        words = [rng.choice(vocab) if rng.random() < 0.6 else rng.choice(["the", "of the", "new york city hall", "new york"]) for _ in range(rng.randint(1, 40))]
        rows.append(("".join(w + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b", "? "]) for w in words), rng.choice(["en", "en", "de", None, "und"])))
    rows += [("the quick brown fox", "fr")] * 40
    return rows


@pytest.mark.parametrize("setting", [{}, {"capacity": 8, "budget": 64, "filter_bits": 1 << 10}, {"least": 3, "top": 25}])
def test_collocations_equal_brute_force(spark, spoken, setting):
    docs = spark.createDataFrame([(t, x, 1, "clash") for t, x in spoken], "text string, lang string, n int, phrase string").repartition(5)
    got = sorted(tuple(r) for r in col.collocations(docs, **setting).collect())
    want = brute_collocations(spoken, setting.get("least", 30), setting.get("top", 2000))
    assert got == want and len(want) > 10


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert col.collocations(docs).count() == 0
    assert col.collocations(spark.createDataFrame([(None, None), ("a", "en")], "text string, lang string")).count() == 0


def test_equal_ids_start_anew_with_another_seed(spark, monkeypatch):
    docs = spark.createDataFrame([("b c", "en")] * 40, "text string, lang string")
    seeds, real = [], col.word_counts

    def clashing(rows, seed):
        seeds.append(seed)
        out = real(rows, seed)
        return out.selectExpr("CAST(1 AS BIGINT) AS id", "lang", "word", "n") if seed == 0 else out

    monkeypatch.setattr(col, "word_counts", clashing)
    assert [r["phrase"] for r in col.collocations(docs).collect()] == ["b c"] and seeds == [0, 1]


def test_new_queries_are_registered_with_sql():
    for name in ("op11_url_filter", "op12_filter_audit", "op13_collocations"):
        assert name in queries.QUERIES and name in queries.ORACLE_SQL


# -- shared kernels and stage columns --------------------------------------------------------------


def test_hashing_in_ranges_equals_hashing_at_once():
    rng = random.Random(8)
    raw = bytes(rng.choice(b"ab  ") for _ in range(4000)) + b"x" * 1500 + b" y"
    buf = np.frombuffer(raw, np.uint8)
    words = B.Words(buf, np.array([0, 900, 900, len(raw)]), B.NON_BLANK)
    whole = words.hashes(1 << 20)
    assert len(set(whole.tolist())) == len({raw[a:b] for a, b in zip(words.starts, words.ends)})
    for size in (1, 7, 64, 1000):
        assert (words.hashes(size) == whole).all()


def test_windows_over_range_edges(monkeypatch):
    h = B.mix(np.arange(5000, dtype=U64))
    ranges = np.array([0, 3, 700, 700, 5000])
    want = B.ngram_hashes(h, ranges, 4)
    monkeypatch.setattr(B, "RANGE", 97)
    got = B.ngram_hashes(h, ranges, 4)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and len(got[1]) == 694 + 4297


AWKWARD = ["__h1", "__h2", "__row", "__own", "__bad", "__worse", "a.b", "h1", "key", "uid", "c`d"]


def test_stages_keep_columns_of_any_name(spark):
    from itemrollup.llm.decontaminate import drop_contaminated
    from itemrollup.llm.near_dups import drop_near_duplicates
    from itemrollup.llm.quality_rules import keep_good
    from itemrollup.llm.secret_scan import redact

    rng = random.Random(1)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(n))
    passage = say(30)
    texts = [say(80), say(90) + " " + passage, say(70) + " password = 9f$Kq!v82Lm@xZ", "", None]
    rows = [(i, t, *[f"{n}-{i}" for n in AWKWARD]) for i, t in enumerate([*texts, texts[0]])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in AWKWARD))
    bench = spark.createDataFrame([("i", passage)], "item_id string, text string")
    outs = [drop_near_duplicates(docs), drop_contaminated(docs, bench), redact(docs), keep_good(docs, None)]
    for out, ids in zip(outs, ([0, 1, 2, 3, 4], [0, 2, 3, 4, 5], [0, 1, 2, 3, 4, 5], [0, 1, 2, 5])):
        assert out.columns == docs.columns
        got = {r[0]: tuple(r)[2:] for r in out.collect()}
        assert got == {i: tuple(f"{n}-{i}" for n in AWKWARD) for i in ids}


def test_packing_numbers_without_moving_sequences(spark):
    from itemrollup.llm import packing

    docs = spark.createDataFrame([(i, "w " * (i % 37)) for i in range(3000)], "doc_id bigint, text string").repartition(7)
    out = packing.pack(docs, max_len=20, buckets=4, budget=60)
    rows = out.collect()
    for b in {r["bucket"] for r in rows} - {None}:
        own = [r for r in rows if r["bucket"] == b]
        room = 60 // own[0]["bucket_len"]
        assert sorted((r["batch"], r["slot"]) for r in own) == [(k // room, k % room) for k in range(len(own))]
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert not [line for line in shuffled if "sequence" in line]


def test_pipeline_leaves_only_what_its_result_reads(spark, tmp_path):
    import os

    import corpus_pipeline
    from itemrollup.session import staging_root

    root = os.path.join(staging_root(spark).removeprefix("file:"), "itemrollup")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(root)) - before}
    assert left == {"pipeline-secrets", "sequences", "slot-begins"} and out.count() > 0
