"""Every dealt query against a plain computation over the same whole tables, or held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from tripflow.llm import language, licenses, lines, quality, queries, toxicity

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TABLES = "documents pages benchmark labels conversations".split()


def words(text):
    return WORD.findall((text or "").translate(ASCII))


@pytest.fixture(scope="module")
def tables(data):
    return {t: pd.read_parquet(f"{data}/{t}.parquet") for t in TABLES}


def result(spark, data, name):
    return queries.QUERIES[name](spark, data).toPandas()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    got, want = result(spark, data, name), con.execute(queries.ORACLE[name]).df()
    assert set(got.columns) == set(want.columns) and len(got) == len(want) > 0
    key = ["conv_id", "depth"] if "depth" in got.columns else got.columns[0]
    got, want = (x.sort_values(key, ignore_index=True)[sorted(want.columns)] for x in (got, want))
    got, want = (x.astype(object).where(x.notna(), None) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_warc(spark, data, tables):
    got = result(spark, data, "op1_warc").set_index("page_id")
    pages = tables["pages"]
    first = pages.groupby(pages.html.fillna("")).page_id.min()
    for page, html in zip(pages.page_id, pages.html.fillna("")):
        row, payload = got.loc[page], html.encode()
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert row.record_type == ("response" if first[html] == page else "revisit")
        assert pd.isna(row.refers_to) if first[html] == page else row.refers_to == first[html]


def occurrences(tokens, benchmark):
    spans, items = set(), set()
    for item, own in benchmark:
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(tokens) - n + 1):
            if n and tuple(tokens[i : i + n]) in windows:
                spans.update(range(i, i + n))
                items.add(str(item))
    return spans, sorted(items)


def test_decontamination(spark, data, tables):
    got = result(spark, data, "op2_decontaminate").set_index("doc_id")
    benchmark = [(i, words(t)) for i, t in zip(tables["benchmark"].item_id, tables["benchmark"].text)]
    for doc, text in zip(tables["documents"].doc_id, tables["documents"].text):
        tokens = words(text)
        hit, items = occurrences(tokens, benchmark)
        row = got.loc[doc]
        assert (row.n_words, row.n_hit, row.n_items) == (len(tokens), len(hit), len(items))
        assert row.items_sha256 == hashlib.sha256(",".join(items).encode()).hexdigest()
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(tokens))
    assert got.contaminated.any() and not got.contaminated.all()


def simhash(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    parts = [" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or ([" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, data, tables):
    docs = tables["documents"]
    got = result(spark, data, "op3_simhash").set_index("doc_id")
    prints = [simhash(t) for t in docs.text]
    assert [got.loc[d].fingerprint for d in docs.doc_id] == [f"{p:016x}" for p in prints]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2).tolist():
            parent[root(i)] = root(j)
    least = defaultdict(lambda: 1 << 62)
    for i, d in enumerate(docs.doc_id):
        least[root(i)] = min(least[root(i)], d)
    assert [got.loc[d].component_id for d in docs.doc_id] == [least[root(i)] for i in range(len(docs))]
    assert got.component_id.nunique() < len(docs)


def test_language(spark, data, tables):
    docs = tables["documents"].set_index("doc_id")
    got = result(spark, data, "op4_language").set_index("doc_id")
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.index]).all()
    held = got[got.held_out]
    assert (held.lang_pred == docs.lang.loc[held.index]).mean() > 0.95
    assert got.rejected.mean() < 0.03 and got.score.between(0, 1).all()


def test_bpe(spark, data, tables):
    got = result(spark, data, "op6_bpe").set_index("doc_id")
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc, text in zip(tables["documents"].doc_id, tables["documents"].text.fillna("")):
        ids = encoding.encode_ordinary(text)
        row = got.loc[doc]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_toxicity(spark, data, tables):
    got = result(spark, data, "op7_toxicity").set_index("doc_id")
    labels = tables["labels"].set_index("doc_id").toxic
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.index]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out & got.index.isin(labels.index)]
    # A twentieth of the labels is flipped, so some of those called toxic hold no toxic word.
    assert (held.predicted == labels.loc[held.index]).mean() > 0.88


def toxic_by_hand(docs, toxic):
    """Model and scores by the formulas of the method, without Spark; ``toxic`` has the label of learnable documents."""
    texts = [(toxic[d], words(t)) for d, t in docs if d in toxic]
    n = {label: sum(x == label for x, _ in texts) for label in (0, 1)}
    held = {label: Counter(w for x, own in texts if x == label for w in set(own)) for label in (0, 1)}
    total = {label: sum(held[label].values()) for label in (0, 1)}
    every = len(texts)
    scores = {}
    for word in held[0].keys() | held[1].keys():
        prior = toxicity.PRIOR * (held[0][word] + held[1][word]) / every
        odds, spread = [], 0
        for label in (1, 0):
            have = held[label][word] + prior * n[label] / every
            all_words = total[label] + toxicity.PRIOR * (total[0] + total[1]) / every * n[label] / every
            odds.append(have / (all_words - have))
            spread += 1 / have
        if abs(math.log(odds[0] / odds[1])) >= toxicity.MIN_Z * math.sqrt(spread):
            scores[word] = math.log(odds[0] / odds[1])
    tokens, clean = Counter(), Counter()
    for label, own in texts:
        tokens.update(own)
        clean.update(own if not label else [])
    prior = toxicity.PRIOR * sum(tokens.values()) / every
    shares = {w: (clean[w] + prior * tokens[w] / sum(tokens.values())) / (sum(clean.values()) + prior) for w in scores}
    drift = toxicity.DRIFT + max(0, sum(shares[w] * s for w, s in scores.items()))
    rest = 1 - sum(shares.values())
    value = lambda x: sum(p * np.exp(x * (scores[w] - drift)) for w, p in shares.items()) + rest * np.exp(-x * drift) - 1
    low, high = 1e-6, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)

    def best_segments(values, lo, hi):
        """The best segment and, on either side of it, the others."""
        sums = np.concatenate([[0.0], np.cumsum(values[lo:hi])])
        low_at, best = 0, (0.0, 0, 0)
        for j in range(1, len(sums)):
            if sums[j] - sums[low_at] > best[0] + 1e-12:
                best = (sums[j] - sums[low_at], low_at, j)
            if sums[j] <= sums[low_at]:
                low_at = j
        if best[0] <= 0:
            return []
        a, b = lo + best[1], lo + best[2]
        return best_segments(values, lo, a) + [best[0]] + best_segments(values, b, hi)

    found = {d: (len(words(t)), best_segments([scores.get(w, 0) - drift for w in words(t)], 0, len(words(t)))) for d, t in docs}
    seen, exposure = 0, 0.0
    for d, label in toxic.items():
        if not label and found[d][0]:
            seen += bool(found[d][1])
            exposure += found[d][0] * math.exp(-high * max(found[d][1], default=0))
    k = max(1, seen) / exposure
    statistic = {}
    for d, (size, segments) in found.items():
        e = [k * size * math.exp(-high * s) for s in segments]
        statistic[d] = math.log1p(sum(-math.log(max(x, 1e-300)) for x in e if x < toxicity.MAX_E))
    # The logistic curve with the same weak pull, by plain gradient steps on its two weights.
    x, y = np.array([statistic[d] for d in toxic]), np.array(list(toxic.values()), float)
    loss = lambda w: float(np.logaddexp(0, w[0] + w[1] * x).sum() - (y * (w[0] + w[1] * x)).sum() + 0.005 * (w**2).sum())
    w, step = np.zeros(2), 1.0
    while step > 1e-9:
        moves = [w + step * np.array(m) for m in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -0.5), (-1, 0.5))]
        nearer = min(moves, key=loss)
        w, step = (nearer, step * 1.1) if loss(nearer) < loss(w) - 1e-13 else (w, step / 2)
    return scores, high, {d: 1 / (1 + math.exp(-(w[0] + w[1] * s))) for d, s in statistic.items()}


def test_toxicity_against_its_formulas(spark):
    data = "/root/testdata/sf0.01"  # the smallest tables with labels enough for any word to score
    docs, labels = (pd.read_parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    learnable = {d: int(t) for d, t in zip(labels.doc_id, labels.toxic) if zlib.crc32(str(d).encode()) % 5 and t == t}
    by_doc = list(zip(docs.doc_id, docs.text))
    learnable = {d: learnable[d] for d, _ in by_doc if d in learnable}
    scores, rate, want = toxic_by_hand(by_doc, learnable)
    got = result(spark, data, "op7_toxicity").set_index("doc_id").score
    assert scores and 0 < rate < 50
    assert [got[d] for d in want] == pytest.approx(list(want.values()), abs=2e-3)


def notices(tokens):
    """Labels and best containment by trying every window of words for every template."""
    found, best = set(), 0.0
    for label, text in licenses.TEMPLATES:
        own = set(words(text))
        must, ends = (set(x.split()) for x in licenses.MARKS.get(text, ("", "")))
        width = math.ceil(len(words(text)) * licenses.SPAN)
        for i in range(len(tokens)):
            if tokens[i] in own:
                window = tokens[i : i + width]
                window = window[: next((k for k, w in enumerate(window) if w in ends), len(window))]
                share = len(own & set(window)) / len(own)
                if share >= licenses.THRESHOLD and must <= set(window):
                    found.add(label)
                    best = max(best, share)
    return found, best


def check_licenses(got, docs):
    for doc, text in docs:
        tokens = words(text)
        places, base = [], set()
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            at = [i for i in range(len(tokens)) if tokens[i : i + len(parts)] == parts]
            places += at
            base |= {label} if at else set()
        found, best = notices(tokens)
        row = got.loc[doc]
        assert (row.n_words, row.n_base) == (len(tokens), len(places))
        assert (row.first_word, row.last_word) == (min(places), max(places)) if places else pd.isna(row.first_word)
        assert row.base_labels == ",".join(sorted(base)) and row.labels == ",".join(sorted(base | found))
        assert row.score == pytest.approx(1.0 if places else best)


def test_licenses(spark, data, tables):
    got = result(spark, data, "op8_licenses").set_index("doc_id")
    check_licenses(got, zip(tables["documents"].doc_id, tables["documents"].text))
    assert (got.labels != got.base_labels).any()


def test_licenses_of_texts_made_of_notices(spark, tmp_path):
    """Whole, cut, shuffled and mixed notices, far more than the given tables hold."""
    rng, texts = random.Random(8), []
    parts = [t for _, t in licenses.TEMPLATES]
    stray = "nc sa nd noncommercial public mozilla the of license and or".split()
    for _ in range(400):
        text = []
        for _ in range(rng.randrange(1, 5)):
            own = rng.choice(parts).split()
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(own))
                own[k : k + rng.randrange(0, 2)] = rng.choice(([], [rng.choice(stray)], ["foo", "\n# "]))
            text += own[rng.choice((0, 0, 1, 3)) :] + ["x"] * rng.choice((0, 1, 9))
        texts.append(" ".join(text))
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    frame.to_parquet(f"{tmp_path}/documents.parquet")
    got = result(spark, str(tmp_path), "op8_licenses").set_index("doc_id")
    check_licenses(got, enumerate(texts))
    assert got.labels.nunique() > 30


def measured(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2))
    covered = {i + k for i in range(len(tokens) - 2) if windows[tuple(tokens[i : i + 3])] > 1 for k in range(3)}
    full = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(tokens), sum(map(len, tokens)), symbols, len(full) - len(set(full)), len(covered)


def test_quality(spark, data, tables):
    got = result(spark, data, "op10_quality").set_index("doc_id")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for doc, text in zip(tables["documents"].doc_id, tables["documents"].text):
        row, want = got.loc[doc], measured(text)
        assert tuple(row[columns]) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    votes = [ballot(t or "", measured(t)) for t in tables["documents"].text]
    assert [tuple(got.votes[d]) for d in tables["documents"].doc_id] == votes
    want = dict(zip(tables["documents"].doc_id, posteriors(np.array(votes))))
    assert [got.posterior[d] for d in want] == pytest.approx(list(want.values()), abs=1e-6)
    assert all(got.kept[d] == (not got.base_failed[d] and p >= 0.5) for d, p in want.items())
    # Nearly all that passes the base rule is clean, and is kept.
    assert got.kept[~got.base_failed].mean() > 0.8


def ballot(text, found):
    """The rules' votes, written out once more."""
    words, chars, symbols, dup_lines, repeats = found
    lines = sum(bool(x.strip(" \t\r\x0b\x0c")) for x in text.split("\n"))
    capitals, stops = sum("A" <= c <= "Z" for c in text), sum(c in ".!?" for c in text)

    def by_ratio(part, of, good, bad):
        return 0 if not of else 1 if part / of <= good else -1 if part / of > bad else 0

    mean = chars / words if words else None
    return (
        1 if words >= 50 else -1 if words < 20 else 0,
        by_ratio(symbols, words, 0.05, 0.2),
        by_ratio(symbols, chars, 0.01, 0.03),
        by_ratio(dup_lines, lines, 0.1, 0.3),
        by_ratio(repeats, words, 0.15, 0.5),
        by_ratio(capitals, chars, 0.12, 0.3),
        0 if mean is None else 1 if 3 <= mean <= 10 else -1 if mean < 2 or mean > 14 else 0,
        0 if words < 20 else 1 if 100 * stops >= words else -1 if 400 * stops < words else 0,
    )


def posteriors(votes):
    """EM over documents instead of patterns, in logarithms."""
    yes, no, said = votes > 0, votes < 0, votes != 0
    praise = np.tile([[0.95], [0.5]], votes.shape[1])  # of good, of bad documents
    good = 0.8

    def expect():
        odds = np.log(good / (1 - good)) + yes @ np.log(praise[0] / praise[1]) + no @ np.log((1 - praise[0]) / (1 - praise[1]))
        return 1 / (1 + np.exp(-odds))

    for _ in range(quality.ROUNDS):
        p = expect()
        good = np.clip(p.mean(), 0.01, 0.99)
        weight = np.stack([p, 1 - p])
        up, every = weight @ yes + [[0.95], [0.5]], weight @ said + 1
        rates = up / every
        silent = rates[0] < rates[1]  # a rule that would count against its own vote says nothing
        rates[:, silent] = (up.sum(axis=0) / every.sum(axis=0))[silent]
        praise = np.clip(rates, 0.001, 0.999)
    return expect()


def test_pipeline(spark, data, tables):
    got = corpus_pipeline.run(spark, data).toPandas().set_index("doc_id")
    docs = tables["documents"]
    model = language.Classifier(
        language.learn(spark.read.parquet(f"{data}/documents.parquet"), queries.learnable_language())
    )
    docs = docs[[not model.classify(t)[2] for t in docs.text]]
    pages, on = Counter(docs.source), Counter()
    bare = lambda x: x.strip(" \t\r\x0b\x0c")
    for source, text in zip(docs.source, docs.text):
        on.update((source, x) for x in {bare(x) for x in text.split("\n")} - {""})
    over = {k for k, n in on.items() if n >= lines.MIN_PAGES and n > lines.RATIO * pages[k[0]]}
    texts = {
        d: "\n".join(x for x in t.split("\n") if (s, bare(x)) not in over)
        for d, s, t in zip(docs.doc_id, docs.source, docs.text)
    }
    prints = {d: simhash(t) for d, t in texts.items()}
    left, kept = dict(sorted(prints.items())), []
    while left:
        first = next(iter(left))
        group, seen = [left.pop(first)], 0
        while seen < len(group):
            near = [d for d, p in left.items() if (p ^ group[seen]).bit_count() <= 2]
            group += [left.pop(d) for d in near]
            seen += 1
        kept.append(first)
    benchmark = [(i, words(t)) for i, t in zip(tables["benchmark"].item_id, tables["benchmark"].text)]
    clean = []
    for d in kept:
        tokens = words(texts[d])
        hit, _ = occurrences(tokens, benchmark)
        if not hit or 20 * len(hit) < len(tokens):
            clean.append(d)
    assert sorted(got.index) == sorted(clean)
    assert all(got.decoded_sha256[d] == hashlib.sha256(texts[d].encode()).hexdigest() for d in clean)
