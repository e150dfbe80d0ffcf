"""Cases in which an operator once did less than its whole job."""

import base64
import collections
import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from itemrollup.llm import near_dups as nd
from itemrollup.llm import decontaminate as dec
from itemrollup.llm import lang_id, packing, quality_rules, queries, secret_scan, token_counts
from itemrollup.llm.common import prepare
from itemrollup.llm.labelled import labelled_texts


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.mark.parametrize("units,size", [(4096, 32 << 20), (2, 32 << 20), (4, 1 << 20), (4096, 1500)])
def test_pairs_that_share_one_large_bucket_are_compared(spark, monkeypatch, units, size):
    monkeypatch.setattr(nd, "LOCAL_UNITS", units)
    monkeypatch.setattr(nd, "LOCAL_BYTES", size)
    rng = random.Random(5)
    texts = []
    for family in range(6):
        words = [f"f{family}w{rng.randint(0, 5000)}" for _ in range(80)]
        texts += [" ".join(words), " ".join([*words[:-1], "edit"])] + ([" ".join([*words[:-1], "other"])] if family % 2 else [])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = nd.units_of(docs)
    # one band in common, every other key of its own
    one = found.withColumn("keys", F.array(F.lit(99).cast("long"), F.xxhash64("uid"), F.xxhash64("uid", F.lit(1))))
    labels, _ = nd.link_units(docs, one, 0.8)
    root = {r["doc_id"]: r["root"] for r in labels.join(one, F.col("node") == F.col("uid")).collect()}
    want = {i: int(t[1]) for i, t in enumerate(texts)}
    assert set(root) == set(want)
    assert {(i, j) for i in root for j in root if root[i] == root[j]} == {(i, j) for i in want for j in want if want[i] == want[j]}


def test_quality_probabilities_keep_the_class_shares_of_all_labels(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(40)]
    # texts that tell nothing of their label: the probability is the share of good labels, 0.9
    rows = [(i, " ".join(rng.choices(vocab, k=80)), int(i % 10 > 0)) for i in range(3000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, quality int")
    for per_class in (300, 5000):  # sampled to equal shares, and not sampled
        out = quality_rules.quality_rules(docs, labels, per_class).collect()
        assert abs(sum(r["score"] for r in out) / len(out) - 0.9) < 0.06, per_class


@pytest.mark.parametrize("before,value", [
    ("Authorization: Bearer ", "q7Zr.92LmXw-Tk4vB"), ("Authorization: Basic ", "dXNlcjp4OSRLcSF2ODI="), ('"authorization": "token ', "ghp_8Kd2mQ0sVx"),
    ("token: password: ", "x9$Kq!v82Lm@"), ("secret: token: pwd = ", "x9$Kq!v82Lm@"), ("pwd:" * 50 + " pwd: ", "x9$Kq!v82Lm@"), ("authorization: ", "x9$Kq!v82Lm@")])
def test_values_after_a_credential_word_that_is_a_value_itself(spark, before, value):
    text = f"see {before}{value} there"
    guesses = [(s, e) for s, kind, e in secret_scan.spans_of(text) if kind == "guess"]
    assert (4 + len(before), 4 + len(before) + len(value)) in guesses
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert value not in secret_scan.redact(df).first()["text"]


def test_nested_values_share_the_costs_of_their_run():
    value = "pwd:token=secret=qwerty1990"
    costs = secret_scan.suffix_costs(value)
    for start in (0, 4, 10, 17):
        assert abs(costs[start] - secret_scan.guess_cost(value[start:])) < 1e-9
    assert [s for s in secret_scan.spans_of("password is basic password") if s[1] == "guess"] == []


BENIGN = """the password is incorrect|your token is deprecated since v2|authorization: required for admins|credentials: application default
passcode is confidential information|the secret is consistency|api key is unavailable|her password is forgotten again|bearer authentication is supported
the token is expired, please renew|password: <required>|password is unchanged|a credential is something you know|your passphrase is important
secret is hidden-somewhere|the access key is temporary|private key is protected|the pwd is displayed below|authorization: denied|credentials: unauthenticated users
token is 'authenticated'.|passcode is changed every monday|password: see documentation|the auth key is rejected|secret is p4ssw0rd|the password is qwertyuiop
the pwd is 20240131|api-key is generated automatically|the passwd is stored encrypted|credential = refreshable""".replace("\n", "|").split("|")


def test_ordinary_words_after_a_credential_word_are_no_secrets():
    assert len(BENIGN) == 30
    for text in BENIGN:
        assert [s for s in secret_scan.spans_of(text) if s[1] == "guess"] == [], text
    text = 'password="x9$Kq!v82Lm@"###'
    assert [text[s:e] for s, kind, e in secret_scan.spans_of(text) if kind == "guess"] == ["x9$Kq!v82Lm@"]


def form_costs(part, words):
    """The cost of one segment in every form it has, straight from the forms' definitions."""
    low = part.lower()
    log, two, n = math.log10, math.log10(2), len(part)
    char = lambda c: log(10 if c.isdigit() else 26 if c.isalpha() else 33)
    if n == 1:
        yield char(part)
    swap = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
    plain = "".join(swap.get(c, c) for c in low)
    if plain in words:
        yield log(words.index(plain) + 2) + two * (1 + sum(a != b for a, b in zip(low, plain)) + (0 if part == low else 2))
    if secret_scan.DATE.fullmatch(part):
        yield log(365 * 120) + two
    if n >= 3 and len(set(low)) == 1:
        yield char(part[0]) + log(n) + two
    if n >= 4 and all(secret_scan._adjacent(a, b) for a, b in zip(low, low[1:])):
        yield log(94 * n) + 0.2 * (n - 1) + two
    for u in (2, 3, 4):
        if n % u == 0 and n // u >= 3 and part == part[:u] * (n // u):
            yield sum(map(char, part[:u])) + log(n // u) + two


def test_guess_cost_is_the_minimum_over_all_segmentations():
    words = ["pass", "user", "love", "xyz", "password"]
    rng = random.Random(5)
    parts = ["pass", "User", "l0ve", "p4ss", "qwerty", "1990", "ooo", "xyxyxy", "Zq", "7", "!", "xyz", "2024", "lkjh"]
    for _ in range(150):
        value = "".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))[:10]
        want = math.inf
        for cuts in itertools.product([0, 1], repeat=max(0, len(value) - 1)):  # every segmentation
            edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(value)]
            segments = [value[a:b] for a, b in zip(edges, edges[1:]) if b > a]
            want = min(want, sum(min(form_costs(x, words), default=math.inf) for x in segments))
        assert abs(secret_scan.guess_cost(value, secret_scan.Dictionary.of(words)) - want) < 1e-9, value


def test_near_duplicates_report_no_partial_link_count(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None)], "doc_id bigint, text string")
    out = nd.near_duplicates(docs)
    assert out.columns == ["doc_id", "class_id"] and {(r[0], r[1]) for r in out.collect()} == {(1, 1), (2, 1), (3, 3)}


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def automaton():
    return token_counts.build(token_counts.load_pieces())


def test_pieces_of_a_word_are_as_many_as_counted(automaton):
    rng = random.Random(9)
    words = [b"a", "\u4f60\u597d\u4e16\u754c".encode() * 40, base64.b64encode(rng.randbytes(600)), b"-" * 300, b"internationalization"]
    for w in words:
        starts = automaton.token_starts(w)
        buf = packing.np.frombuffer(w, packing.np.uint8)
        assert len(starts) == automaton.lengths(buf, packing.np.array([0]), packing.np.array([len(w)]))[0]
        assert starts == sorted(starts) and starts[0] == 0


def test_packing_bounds_real_tokens_and_carries_the_texts(spark, automaton):
    rng = random.Random(10)
    prose = "  the quick brown fox, internationalization \u00e9t\u00e9 \n" * 30
    texts = [None, "", "  ", prose, "\u4f60\u597d\u4e16\u754c" * 500, base64.b64encode(rng.randbytes(3000)).decode(), prose + "x", "one"]
    rows = [*enumerate(texts), (None, prose), (None, "two words"), (3, "again 3")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = packing.pack(docs, automaton=automaton, max_len=50, buckets=3, budget=200).collect()
    whole = collections.defaultdict(list)
    for r in out:
        whole[r["row_id"], r["doc_id"]].append(r)
        assert r["n_tokens"] <= 50 and (r["sequence"] is None or len(r["sequence"]) == r["end_byte"] - r["start_byte"])
    got = collections.Counter()
    for (_, doc), pieces in whole.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        body = None if pieces[0]["sequence"] is None else b"".join(bytes(r["sequence"]) for r in pieces).decode()
        got[doc, body, sum(r["n_tokens"] for r in pieces)] += 1
    counts = token_counts.count_tokens(docs, keep=("doc_id", "text")).collect()
    assert got == collections.Counter((r["doc_id"], r["text"], r["n_tokens"]) for r in counts)
    assert max(len(p) for p in whole.values()) > 20


def test_registered_packing_uses_the_token_counts(spark):
    out = queries.op9_packing(spark, SF).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
    want = queries.op1_token_counts(spark, SF).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def test_samples_hold_one_row_of_a_repeated_key(spark):
    rows = [(i, f"text {i}", "en") for i in range(20)] + [(3, f"copy {i}", "de") for i in range(300)] + [(4, "same", "en")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int")
    got = labelled_texts(docs, labels, "quality", 10).collect()
    assert sorted((r["doc_id"], r["label"]) for r in got) == [(i, i % 2) for i in range(20)]
    assert {(r["doc_id"], r["text"]) for r in got} <= {r[:2] for r in rows}
    assert len(lang_id.training_rows(docs, F.lit(True), 20)) == 21  # key 3 has a second language


def test_a_rare_language_is_learned_from_a_sampled_table(spark):
    rng = random.Random(11)
    say = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(12))
    rows = [(i, say("uvwxyz") if i % 100 == 0 else say("abcdef"), "rare" if i % 100 == 0 else "usual") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = collections.Counter(r[0] for r in lang_id.training_rows(docs, F.lit(True), 25))
    assert got == {"rare": 25, "usual": 25}  # a plain sample of 50 rows has none or few of the rare ones
    out = {r["doc_id"]: r["lang_pred"] for r in lang_id.language_id(docs, sample=25).collect()}
    assert all(out[r[0]] == r[2] for r in rows)


@pytest.mark.parametrize("block_bytes", [dec.ITEM_BLOCK_BYTES, 100])
def test_items_without_an_id_contaminate(spark, block_bytes):
    passage = " ".join(f"p{i}" for i in range(14))
    bench = spark.createDataFrame([(None, passage), (7, "q " * 12), (None, "...")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "so " + passage + " end"), (2, passage + " q" * 12), (3, "clean"), (4, None)], "doc_id bigint, text string")
    out = {r["doc_id"]: r for r in dec.decontaminate(docs, bench, block_bytes=block_bytes).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    cols = ("n_hit", "n_items", "items_sha256", "contaminated", "n_near_items")
    assert tuple(out[1][c] for c in cols) == (14, 0, sha(""), True, 0)
    assert tuple(out[2][c] for c in cols) == (26, 1, sha("7"), True, 1)
    assert not out[3]["contaminated"] and not out[4]["contaminated"]
    assert {r["doc_id"] for r in dec.drop_contaminated(docs, bench).collect()} == {3, 4}
