"""Merkle manifest, token counts and prefix trie against plain computations, and their odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripflow.llm import merkle, queries, token_counts, trie

# --- 11 ---------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Levels of a tree of hex digests."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def route(levels, i):
    """The other node of the run at each level, with its side."""
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append(("none", "") if j >= len(level) else ("left" if j < i else "right", level[j]))
        i >>= 1
    return out


def manifest_by_hand(rows, claims):
    """rows: (group, id, leaf); claims by place in rows."""
    groups = defaultdict(list)
    for place, (group, doc, leaf) in enumerate(rows):
        groups[group].append((doc is not None, doc if doc is not None else 0, leaf, place))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = {}
    for k, g in enumerate(order):
        for i, (*_, leaf, place) in enumerate(sorted(groups[g])):
            steps = route(trees[g], i) + route(top, k)
            h = claims.get(place) or leaf
            for side, other in steps:
                h = sha(h) if side == "none" else sha(other, h) if side == "left" else sha(h, other)
            out[place] = (leaf, trees[g][-1][0], top[-1][0], sha(*(o for _, o in steps)), h)
    return out


@pytest.mark.parametrize("levels", [1, 2, 9])
def test_manifest_against_hand_made_trees(spark, levels):
    rng = random.Random(levels)
    rows = [(g, i, sha(f"{g}{i}")) for g, n in (("a", 37), (None, 5), ("", 1), ("é", 16), ("Z", 2)) for i in range(n)]
    rows += [("a", None, sha("x")), ("a", 3, sha("y")), ("a", 3, sha("y"))]
    rng.shuffle(rows)
    claims = {i: sha(f"claim {i}") for i in range(0, len(rows), 4)}
    given = [(g, i, bytes.fromhex(leaf), bytes.fromhex(claims[k]) if k in claims else None) for k, (g, i, leaf) in enumerate(rows)]
    leaves = spark.createDataFrame(given, "_group string, _id bigint, _leaf binary, _claim binary")
    got = merkle.verify(merkle.proofs(spark, merkle.build(spark, leaves, levels))).collect()
    shown = sorted(tuple(bytes(r[c]).hex() for c in ("_leaf", "_subroot", "_root", "_siblings", "_folded")) for r in got)
    want = manifest_by_hand(rows, claims)
    # Which of two equal rows carries a claim is not told apart: compare what does not depend on it.
    assert [x[:3] for x in shown] == sorted(x[:3] for x in want.values())
    single = [k for k, x in enumerate(rows) if rows.count(x) == 1]
    by_leaf = {x[0]: x for x in shown}
    assert all(by_leaf[rows[k][2]] == want[k] for k in single)
    assert all((r._folded == r._root) == (r._claim is None or r._claim == r._leaf) for r in got)
    assert sorted((r._group or "", r._id or -1) for r in got) == sorted((g or "", i or -1) for g, i, _ in rows)
    assert [r._group for r in got].count(None) == 5


def test_manifest_is_written_opened_and_asked_for_some_leaves(spark, tmp_path):
    leaves = spark.range(3000).select(
        F.concat(F.lit("g"), F.col("id") % 3).alias("_group"), F.col("id").alias("_id"),
        merkle.leaf_digest(F.col("id")).alias("_leaf"), F.lit(None).cast("binary").alias("_claim"),
    )
    built = merkle.build(spark, leaves, 4, f"{tmp_path}/manifest")
    opened = merkle.open_manifest(spark, f"{tmp_path}/manifest")
    assert len(opened.tiers) == len(built.tiers) == 3 and merkle.root_of(opened) == merkle.root_of(built)
    every = {r._id: bytes(r._folded) for r in merkle.verify(merkle.proofs(spark, built)).collect()}
    assert len(every) == 3000 and set(every.values()) == {bytes.fromhex(merkle.root_of(built))}
    wanted = spark.createDataFrame([(5,), (2999,), (5,), (77_777,)], "doc bigint")
    some = merkle.verify(merkle.proofs(spark, opened, wanted)).collect()
    assert {r._id: bytes(r._folded) for r in some} == {i: every[i] for i in (5, 2999)} and len(some) == 2
    # Another order of the rows, and other builders, give the same root; another row does not.
    again = merkle.build(spark, leaves.orderBy(F.rand(1)).repartition(7), 6)
    assert merkle.root_of(again) == merkle.root_of(built)
    assert merkle.root_of(merkle.build(spark, leaves.where("_id <> 17"), 4)) != merkle.root_of(built)
    assert merkle.root_of(merkle.build(spark, leaves.where("false"), 4)) is None


def test_positions_are_those_of_the_log():
    for leaves in range(1, 40):
        digests = [hashlib.sha256(str(i).encode()).digest() for i in range(leaves)]
        for levels in {merkle.levels_of(leaves), merkle.levels_of(leaves) + 2}:
            log = merkle.append_log(digests, levels)
            nodes = digests
            for level in range(levels + 1):
                assert [log[p] for p in merkle.position(level, np.arange(len(nodes)), leaves).tolist()] == nodes
                nodes = [merkle.node_hash(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
            assert len(log) == sum(-(-leaves >> k) for k in range(levels + 1))


def test_manifest_of_odd_rows(spark, tmp_path):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, _group string, _leaf string, _row string"
    rows = [(7, "ä\n", "x", None, 2**63 - 1, "g", "l", "r"), (7, "ä\n", "x", None, 2**63 - 1, "g", "l", "r"), (None, None, None, "", None, "", "", ""), (1, "w " * 100_000, "", "s", 0, "", "", "")]
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_merkle"](spark, str(tmp_path)).collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = sorted(sha("".join(map(field, (i, s, lang, n, t)))) for i, t, lang, s, n, *_ in rows)
    assert sorted(r.leaf for r in got) == want and len({r.root for r in got}) == 1
    tampered = lambda r: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
    assert all(r.verified != tampered(r) for r in got)
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.QUERIES["op11_merkle"](spark, f"{tmp_path}/none").count() == 0


# --- 12 ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.COUNTED)


def by_library(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    with open(queries.COUNTED, encoding="utf-8") as f:
        return token_counts.Counter(f.read())


def test_counts_of_all_prefixes_against_the_library(library, counter):
    rng = random.Random(5)
    parts = ["a", "b", "the", "'", "'s", "'re", "'l", "l", " ", "  ", "\n", "\t", "1", "23", "é", "　", "中文", "!", "--", "<|endoftext|>",
             "<|endo", "|>", "̀", "\U0001f600", "՘", "࢏", "\x1c", "\x85", "\xa0", "ing", " x", "İ", "  'll", "\r\n", "=====", "aaaaaaa"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))
        assert counter.counts(text).tolist() == [by_library(library, text[:i]) for i in range(len(text) + 1)], repr(text)


def test_character_classes_agree_with_the_library(library, counter):
    # Every 17th code point, beside each class and doubled.
    for c in range(1, 0x30000, 17):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1 {chr(c)}{chr(c)}a {chr(c)}!{chr(c)}"
            assert counter.counts(text)[-1] == by_library(library, text), hex(c)


def test_kept_units_and_pairs_do_not_change_counts(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_UNITS", 3)
    monkeypatch.setattr(token_counts, "KEPT_PAIRS", 3)
    with open(queries.COUNTED, encoding="utf-8") as f:
        small = token_counts.Counter(f.read())
    text = "one two three four one two three four 'tis  " * 3
    assert small.counts(text).tolist() == [by_library(library, text[:i]) for i in range(len(text) + 1)]
    assert len(small.steps) <= 3 and len(small.apart) <= 3


def test_counting_is_linear_in_a_long_pre_token(library, counter):
    import time

    def seconds(n):
        began = time.perf_counter()
        counter.counts("ab" * n)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(400_000) < 60 * max(seconds(20_000), 0.01)
    text = "x" * 20_000 + " " * 20_000 + "中" * 5_000
    assert counter.counts(text)[-1] == by_library(library, text)


def test_token_counts_on_whole_table(spark, data, library):
    got = queries.QUERIES["op12_token_counts"](spark, data).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{data}/documents.parquet")
    for doc, text in zip(docs.doc_id, docs.text.fillna("")):
        row, n = got.loc[doc], by_library(library, text)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 512)
        cut = int(row.chars_within_limit)
        assert by_library(library, text[:cut]) <= 512 and (cut == len(text) or n > 512)
        assert all(by_library(library, text[:i]) > 512 for i in range(cut + 1, min(cut + 30, len(text) + 1)))


def test_token_counts_of_odd_rows(spark, library):
    rows = [(1, None), (1, ""), (None, "hello world"), (2, "x " * 50_000), (2, "x " * 50_000)]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id bigint, text string, counts string, _id string")
    found = token_counts.count_prefixes(spark, docs, queries.COUNTED)
    got = found.select("_id", "n_bytes", token_counts.n_tokens(F.col("counts")).alias("n"), token_counts.tokens_at(F.col("counts"), 5).alias("five"))
    want = [(i, len((t or "").encode()), by_library(library, t or ""), by_library(library, (t or "")[:5])) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert token_counts.count_prefixes(spark, docs.where("false"), queries.COUNTED).count() == 0


def test_prefix_counts_need_not_rise(counter):
    counts = counter.counts("tokenization of supercalifragilistic words")
    assert (np.diff(counts) < 0).any()
    for limit in range(int(counts.max()) + 1):
        assert counts[np.flatnonzero(counts <= limit).max()] <= limit


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        token_counts.Counter(f.read())


# --- 13 ---------------------------------------------------------------------------------

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_by_hand(rows):
    """rows: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tie, role, text))
    convs = {c: [x[3:] for x in sorted(own)] for c, own in convs.items()}
    members = defaultdict(list)
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children, below = defaultdict(int), defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]] += 1
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    own_bytes = lambda u: len(u[-1][1].encode()) if u else 0
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(whole[c]) == len(node))))
        out.append(
            (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node], sum(not children[u] for u in below[node]),
             sum((len(members[u]) - 1) * own_bytes(u) for u in below[node]), sha(ends))
        )
    return sorted(out, key=str)


def nodes(spark, rows, tmp_path, **extra):
    kind = "conv_id bigint, turn bigint, role string, text string, ids string, depth string, key string, _at string"
    path = f"{tmp_path}/{len(rows)}"
    spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], kind).write.parquet(f"{path}/conversations.parquet")
    got = queries.QUERIES["op13_prefix_trie"](spark, path)
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str)


def test_trie_on_whole_table(spark, data):
    rows = pd.read_parquet(f"{data}/conversations.parquet")[["conv_id", "turn", "role", "text"]].itertuples(index=False)
    got = queries.QUERIES["op13_prefix_trie"](spark, data).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == trie_by_hand(list(map(tuple, rows)))


def test_trie_of_common_openings_and_copies(spark, tmp_path):
    rng, rows = random.Random(9), []
    for c in range(400):
        # A third are copies of one conversation, most others share long openings.
        own = list("abcdef") if c % 3 == 0 else [*"abcdefghij"[: rng.randrange(0, 11)], *(rng.choice("xyz") for _ in range(rng.randrange(1, 6)))]
        rows += [(c, i, "user", t) for i, t in enumerate(own)]
    rows += [(5000, i, "user", f"t{i}") for i in range(200)] + [(5005, i, "user", f"t{i}") for i in range(300)]
    assert nodes(spark, rows, tmp_path) == trie_by_hand(rows)


def test_trie_of_odd_rows(spark, tmp_path):
    rows = [(None, 0, "user", "lost"), (3, None, "b", None), (3, None, None, "b"), (3, 1, "a", "é" * 50_000), (3, 1, "a", "z"), (3, 1, "a", "z"),
            (0, 5, "", ""), (10, 0, "user", ""), (-7, 0, "user", "negative"), (-5, 0, "user", "base"), (11, 0, None, None), (12, 0, "x", "y")]
    rows_by_hand = [r for r in rows if r[0] is None or r[0] >= 0]
    got = nodes(spark, rows_by_hand, tmp_path)
    assert got == trie_by_hand(rows_by_hand)
    assert len(nodes(spark, rows, tmp_path)) >= len(got)  # negative ids have a family as well
    assert nodes(spark, [], tmp_path) == []
    # A conversation that keeps no turn is a member of the root alone: of one with an absent base all first turns go.
    lost = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 9 > 1 and c % 5)
    assert nodes(spark, [(lost, 0, "user", "gone")], tmp_path) == [(lost, 0, None, 1, 0, 1, 0, sha(str(lost)))]


def test_sorting_by_blocks_of_columns(monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    rng = random.Random(2)
    for _ in range(200):
        given = list({tuple(rng.choice((1, 2)) for _ in range(rng.randrange(0, 12))) for _ in range(rng.randrange(1, 12))})
        length = np.array([len(x) for x in given], np.int64)
        order, shared = trie.sort_and_compare(np.array([t for x in given for t in x], np.int64), length)
        found = [given[i] for i in order.tolist()]
        assert found == sorted(given)
        for a, b, n in zip(found, found[1:], shared[1:].tolist()):
            assert a[:n] == b[:n] and (len(a) == n or a[n : n + 1] != b[n : n + 1])
