"""Near copies, repeated strings, archives, URL rules, mixing and the pipeline."""

import base64
import hashlib
import os
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from oracle import database, difference
from samples import prose

import corpus_pipeline
from lumbung.llm import components, mixing, queries, simhash, suffix, url_rules, warc
from lumbung.session import stage, stage_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Near copies


def slow_fingerprint(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def slow_roots(values, distance):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(root)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_every_close_pair_meets_at_an_anchor():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 20, np.uint64)
    for distance, radius in ((1, 2), (2, 2), (3, 3)):
        for v in values[:4] if radius == 3 else values:
            places = rng.choice(63, distance, replace=False)
            other = v ^ np.uint64(sum(1 << int(p) for p in places))
            own, far = (set(simhash.anchors(np.array([x]), radius)[1].tolist()) for x in (v, other))
            assert own & far
    # Anchors are words of the code: the exclusive or of the places of their ones is zero.
    for anchor in simhash.anchors(values, 1)[1].tolist():
        s = 0
        for p in range(63):
            s ^= (p + 1) * (anchor >> p & 1)
        assert s == 0
    assert Counter(simhash.anchors(values, 1)[0].tolist()) == Counter(range(20))  # one anchor covers each


@pytest.mark.parametrize("distance", [1, 2])
def test_classes_are_those_of_all_pairs(spark, distance):
    rng = random.Random(distance)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(v)
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randint(0, 63)
    dense = rng.getrandbits(64)
    values |= {dense ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(a)}
    prints = spark.createDataFrame([(simhash.signed(v),) for v in values], "fingerprint bigint")
    got = {r["fingerprint"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in simhash.classes(prints, distance).collect()}
    want = slow_roots(values, distance)
    groups, other = defaultdict(set), defaultdict(set)
    for v in values:
        groups[want[v]].add(v)
        other[got[v]].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, other.values()))


def test_near_copies_of_odd_rows(odd, odd_rows, empty):
    got = simhash.near_copies(odd)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    fps = [slow_fingerprint(t) for _, t, *_ in odd_rows]
    roots, least = slow_roots(fps, 2), {}
    for (i, *_), f in zip(odd_rows, fps):
        least[roots[f]] = min((x for x in (least.get(roots[f]), i) if x is not None), default=None)
    assert rows(got) == sorted([(r[0], f"{f:016x}", least[roots[f]]) for r, f in zip(odd_rows, fps)], key=str)
    assert rows(simhash.near_copies(empty)) == []


def test_one_row_of_each_group_stays(odd, odd_rows, empty):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    fps = {slow_fingerprint(t) for _, t, *_ in odd_rows}
    assert kept.count() == len(set(slow_roots(fps, 2).values()))
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(3) == 1 and 4 not in ids
    assert simhash.keep_one(empty).collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000 + i, 999) for i in range(300)] + [(5000, 3000), (4000, 3000)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {**{i + 1: 0 for i in range(200)}, **{1000 + i: 999 for i in range(300)}, 5000: 3000, 4000: 3000}


# Repeated strings


def slow_repeats(texts, length):
    """texts in order of their ids."""
    seen, out = set(), []
    for t in texts:
        t = (t or "").encode()
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if t[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(t[p : p + length])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), runs, kept))
    return out


def digests(found):
    return [(*f[:3], hashlib.sha256(f[3]).hexdigest()) for f in found]


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(200):
        b = bytes(rng.choice(b"ab\0c"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 60)))
        a = np.frombuffer(b, np.uint8)
        order = suffix.suffix_array(a)
        assert list(order) == sorted(range(len(b)), key=lambda i: b[i:])
        half = len(b) // 2
        shared = suffix.common_prefixes(a, order, np.array([0, half]), np.array([half, len(b) - half]), 5)
        for i in range(1, len(b)):
            x, y = b[order[i - 1] :], b[order[i] :]
            assert shared[i] == next((k for k in range(5) if k >= min(len(x), len(y)) or x[k] != y[k]), 5)


PHRASES = ["the cat sat on the mat ", "é", "dog ", "a" * 30, "xyzzy plugh foo bar ", "\n"]


def repeated_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PHRASES) for _ in range(rng.randint(0, 50))) for _ in range(n)] + ["a" * 200] * 3


def test_repeats_equal_brute_force(table, monkeypatch):
    texts = repeated_texts(1, 60)
    docs = stage(table([(7 * i, t) for i, t in enumerate(texts)]).repartition(5), "shuffled")
    want = [(7 * i, *d) for i, d in enumerate(digests(slow_repeats(texts, 100)))]
    assert rows(suffix.remove_repeats(docs)) == sorted(want, key=str)
    monkeypatch.setattr(suffix, "SHARD", 2000)  # many shards
    monkeypatch.setattr(suffix, "BLOCK", 1500)  # and many arrays, merged by binary search
    assert rows(suffix.remove_repeats(docs)) == sorted(want, key=str)


def test_hot_anchors_do_not_change_the_result(table, monkeypatch):
    rng = random.Random(4)
    line = "licensed under the same terms as the original work, see the file at the top"
    texts = [f"{rng.random()} {line} {rng.choice("abc") * 40} {rng.random()}" for _ in range(80)]
    docs = table(list(enumerate(texts)))
    want = sorted([(i, *d) for i, d in enumerate(digests(slow_repeats(texts, 100)))], key=str)
    assert rows(suffix.remove_repeats(docs)) == want
    found = []
    hot = suffix.hot_anchors
    monkeypatch.setattr(suffix, "hot_anchors", lambda keyed, length: found.append(hot(keyed, length)) or found[-1])
    suffix.remove_repeats(docs).collect()
    assert len(found[0])  # the line was dealt out window by window
    monkeypatch.setattr(suffix, "hot_anchors", lambda keyed, length: np.zeros(0, np.uint64))
    monkeypatch.setattr(suffix, "BLOCK", 1500)
    assert rows(suffix.remove_repeats(docs)) == want


def test_repeats_of_hot_anchors_are_stretches_not_windows(table, monkeypatch):
    """Every window of a hot anchor is a piece of its own; those of one text that are repeats are joined in the task that finds them."""
    rng = random.Random(9)
    page = " ".join(f"{rng.choice(PHRASES).strip()}{rng.randint(0, 99)}" for _ in range(120))
    texts = [page[:at] + str(rng.random()) + page[at:] for at in (rng.randint(0, len(page)) for _ in range(200))]
    docs, own, settled = stage(table(list(enumerate(texts))).repartition(7), "near"), suffix.stage, []

    def seen(df, name):
        done = own(df, name)
        settled.extend([done] if name == "settled-pieces" else [])
        return done

    monkeypatch.setattr(suffix, "stage", seen)
    found = rows(suffix.remove_repeats(docs))
    assert found == sorted([(i, *d) for i, d in enumerate(digests(slow_repeats(texts, 100)))], key=str)
    whole = settled[0].where("h is null")
    assert 200 < whole.count() < 10 * len(texts) < whole.agg(F.sum(F.col("stop") - F.col("start") - 99)).first()[0] / 10


def test_hot_anchors_are_bounded(table, monkeypatch):
    """The anchors with most pieces are hot; the result stays the same."""
    rng = random.Random(7)
    lines = [f"line {i} of the footer that stands at the end of very many pages of this site, see there" for i in range(3)]
    texts = [f"{rng.random()} {lines[0]} {rng.random()} " + f"{lines[1]} {rng.random()} " * (i % 2) + lines[2] * (i % 3 == 0) for i in range(120)]
    docs = table(list(enumerate(texts)))
    keyed = suffix._keyed(docs, "doc_id", "text").select("doc", "row", suffix.TEXT)
    every = suffix.hot_anchors(keyed, 100)
    assert len(every) > 2 and (np.sort(every) == every).all()
    monkeypatch.setattr(suffix, "MOST_HOT", len(every) - 1)
    assert 0 < len(suffix.hot_anchors(keyed, 100)) < len(every)
    assert rows(suffix.remove_repeats(docs)) == sorted([(i, *d) for i, d in enumerate(digests(slow_repeats(texts, 100)))], key=str)


def test_rows_keep_their_names_when_the_scan_is_split_anew(spark, table, monkeypatch):
    """Executors that come or go change how a table is split between jobs; here every staged table does."""
    texts = repeated_texts(5, 300)
    data = [(7 * i % 301, t, "en") for i, t in enumerate(texts)] + [(500, texts[0], "de"), (500, texts[1], "fr"), (None, texts[2], "a"), (None, texts[2], "b")]
    docs = stage(spark.createDataFrame(data, "doc_id bigint, text string, lang string").repartition(9), "split")
    single = [i for i, n in Counter(r[0] for r in data).items() if n == 1]
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    want = sorted([(r[0], *d) for r, d in zip(ordered, digests(slow_repeats([r[1] for r in ordered], 100))) if r[0] in single], key=str)
    sizes, own = [1 << 30, 2000, 9000, 500, 40_000], suffix.stage

    def moved(df, name):
        done = own(df, name)
        sizes.append(sizes.pop(0))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(sizes[0]))
        spark.conf.set("spark.sql.files.openCostInBytes", str(min(sizes[0], 1000)))
        return done

    monkeypatch.setattr(suffix, "stage", moved)
    try:
        found = suffix.remove_repeats(docs)
        first = rows(found)
        for size in sizes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            assert rows(found) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r for r in first if r[0] in single] == want and len(first) == len(data)


def test_repeats_in_odd_rows(odd, odd_rows, empty):
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found = slow_repeats([r[1] for r in ordered], 100)
    want = sorted([(r[0], *d) for r, d in zip(ordered, digests(found))], key=str)
    assert rows(suffix.remove_repeats(odd)) == want
    cut = suffix.without_repeats(odd)
    assert cut.columns == odd.columns
    texts = [(r[0], None if r[1] is None else f[3].decode("utf-8", "ignore")) for r, f in zip(ordered, found)]
    assert rows(cut.select("doc_id", "text")) == sorted(texts, key=str)
    assert {r["__text"] for r in cut.collect()} == {"extra __text"}
    assert suffix.remove_repeats(empty).collect() == suffix.without_repeats(empty).collect() == []


# Archives

PAGES = "page_id bigint, url string, html string"


def test_archives_and_revisits(spark, table):
    nasty = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\n"
    pages = [(i, f"http://a/{i}", prose(i % 7, 20)) for i in range(30)]
    pages += [(30, "http://a\r\nb", nasty), (31, None, nasty), (32, "u", ""), (None, None, None), (None, "v", "only"), (5, "http://a/5", pages[5][2])]
    docs = table(pages, PAGES).withColumns({"type": F.lit("x"), "digest": F.lit("y"), "uri": F.lit("z")})
    got = warc.archive_pages(docs).collect()
    groups, found = defaultdict(list), defaultdict(list)
    for i, _, html in pages:
        groups[base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()].append((i, len((html or "").encode())))
    for r in got:
        found[r["payload_digest"]].append(r)
    assert groups.keys() == found.keys()
    for code, members in groups.items():
        best = max((i for i, _ in members if i is not None), default=None)
        assert Counter((r["page_id"], r["payload_bytes"]) for r in found[code]) == Counter(members)
        assert [r["page_id"] for r in found[code] if r["record_type"] == "response"] == [best]
        assert all(r["refers_to"] == (best if r["record_type"] == "revisit" else None) for r in found[code])


def test_small_payloads_stay_and_archives_can_be_resolved_again(spark, table):
    pages = table([(1, "a", "same payload"), (2, "b", "same payload"), (3, "c", "x"), (4, "d", "x")], PAGES)
    kinds = {r["page_id"]: r["record_type"] for r in warc.archive_pages(pages, min_bytes=5).collect()}
    assert kinds == {1: "revisit", 2: "response", 3: "response", 4: "response"}
    first, second, third = (stage_path(spark, f"warc{i}") for i in range(3))
    warc.write_archive(pages, first)
    warc.resolve_revisits(spark, first, second)
    warc.resolve_revisits(spark, second, third)
    a, b = (rows(warc.read_archive(spark, p, payloads=True).select("type", "page", "uri", "digest", "payload")) for p in (second, third))
    assert a == b and [x[0] for x in a].count("response") == 2
    ids = {r["record_id"]: r for r in warc.read_archive(spark, third).collect()}
    assert all(ids[r["refers_record"]]["type"] == "response" for r in ids.values() if r["type"] == "revisit")


def test_no_pages(table):
    assert warc.archive_pages(table([], PAGES)).collect() == []


# URL rules

RULES = [url_rules.Rule(*r) for r in (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))]


def slow_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


URLS = ["http://WWW.Example.com/en/1", "https://a.example.com/en/", "https://a.example.com/EN/", "http://example.com", "http://xample.net/es/?a=/fr/", "http://net/es/x", "http://evilnet/es/", "ftp://x.com?u=http://y.net/es/", "nothing", "", None, "://", "http://ÄB.com/é", "http://u:p@a.com:80/x#y", "http://a\nb.com/q"]


def test_given_rules(table):
    pages = table([(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[0], None), (0, URLS[0], None)], PAGES)
    none = table([], "url string, bad boolean")
    got = rows(url_rules.judge_urls(pages.withColumns({"tokens": F.lit(1), "host": F.lit(2), "RULE": F.lit(3)}), none, RULES))
    want = [(i, *slow_rule(u)[:3], slow_rule(u)[3] or "allow") for i, u in [*enumerate(URLS), (None, URLS[0]), (0, URLS[0])]]
    assert got == sorted(want, key=str)
    assert url_rules.judge_urls(table([], PAGES), none, RULES).collect() == []


def test_mined_rules_equal_brute_force(table):
    rng = random.Random(9)
    urls = [f"http://{rng.choice(['a', 'b', 'c'])}.{rng.choice(['x', 'y'])}.org/{rng.choice(['p', 'q', 'r'])}/{rng.randint(1, 99)}" for _ in range(400)]
    bad = lambda u: ("//a." in u and "/q/" in u) or rng.random() < 0.02
    known = [(u, bad(u)) for u in urls] + [(None, True), ("http://z.org/", None)]
    pages = table([(i, u, None) for i, u in enumerate(urls)], PAGES)
    frame = pages.select("page_id", url_rules.tokens(url_rules.host(F.col("url")), url_rules.path(F.col("url"))).alias("t"))
    tokens = {urls[r["page_id"]]: frozenset(r["t"]) for r in frame.collect()}
    labelled = [(tokens.get(u, frozenset(["d:"])), b) for u, b in known if b is not None]
    sets = {frozenset(c) for t in set(tokens.values()) for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}
    rules = []
    for s in sets:
        hits = [b for t, b in labelled if s <= t]
        if sum(hits) >= 20 and sum(hits) >= 0.8 * len(hits):
            rules.append(s)
    want = [any(s <= tokens[u] for s in rules) for u in urls]
    judged = url_rules.judge_urls(pages, table(known, "url string, bad boolean"), [], min_support=0.001, min_confidence=0.8)
    got = {r["page_id"]: r["verdict"] == "block" for r in judged.collect()}
    assert [got[i] for i in range(len(urls))] == want and any(want) and not all(want)


@pytest.mark.parametrize("before", [7, 8, 12, 29])
def test_rules_on_late_tokens_of_long_paths(table, before):
    """Bad URLs are told by one word after ``before`` different ones; a site with a third of all pages shares one path."""
    rng = random.Random(before)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    long = [f"http://{word()}.org/" + "/".join(word() for _ in range(before)) for _ in range(300)]
    urls = [u + ("/casino" if i < 134 else "/garden") for i, u in enumerate(long)] + ["http://big.net/a/b"] * 200
    pages = table([(i, u, None) for i, u in enumerate(urls)], PAGES)
    known = table([(u, i < 134) for i, u in enumerate(urls)], "url string, bad boolean")
    got = {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(pages, known, []).collect()}
    assert [got[i] == "block" for i in range(len(urls))] == [i < 134 for i in range(len(urls))]


def test_shared_long_paths_equal_brute_force(table):
    """Thirty path words that always come together are mined as one; each of them alone is a rule of its own."""
    rng = random.Random(4)
    common = "/".join(f"part{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(30))
    kinds = ["", "/x", "/x/y", "/y", "/z", "/z/x"]
    urls = [f"http://s.org/{common if rng.random() < 0.5 else 'partaa' if rng.random() < 0.3 else 'home'}{rng.choice(kinds)}" for _ in range(500)]
    known = [(u, ("partab" in u and "/x" in u) or rng.random() < 0.05) for u in urls]
    others = [f"http://t.org/{p}{k}" for p in ("partab", "partbd/partac", "partaa", "home", "x", common) for k in kinds]
    pages = table([(i, u, None) for i, u in enumerate(urls + others)], PAGES)
    frame = pages.select("url", url_rules.tokens(url_rules.host(F.col("url")), url_rules.path(F.col("url"))).alias("t")).distinct()
    sets = {r["url"]: frozenset(r["t"]) for r in frame.collect()}
    # Of the thirty, all but partaa stand for one another in every combination.
    short = lambda s: frozenset("p:partab" if t.startswith("p:part") and t != "p:partaa" else t for t in s)
    rules = []
    for c in {frozenset(c) for s in sets.values() for n in range(1, len(short(s)) + 1) for c in combinations(sorted(short(s)), n)}:
        hits = [b for u, b in known if c <= short(sets[u])]
        if sum(hits) >= 20 and sum(hits) >= 0.8 * len(hits):
            rules.append(c)
    judged = url_rules.judge_urls(pages, table(known, "url string, bad boolean"), [], min_support=0.001, min_confidence=0.8)
    got = {r["page_id"]: r["verdict"] == "block" for r in judged.collect()}
    want = [any(c <= short(sets[u]) for c in rules) for u in urls + others]
    assert [got[i] for i in range(len(want))] == want and any(want[500:]) and not all(want[500:])


# Mixing


def slow_fill(children, budget):
    """{name: (weight, capacity)} -> amounts, by repeated proportional sharing."""
    out, open_ = {}, dict(children)
    while open_:
        total = sum(w for w, _ in open_.values())
        left = budget - sum(out.values())
        full = {n: c for n, (w, c) in open_.items() if c * total <= w * left}
        if not full:
            return out | {n: int(Fraction(w * left, total)) for n, (w, _) in open_.items()}
        out |= full
        open_ = {n: x for n, x in open_.items() if n not in full}
    return out


def slow_mix(docs, t):
    leaves = defaultdict(list)
    for i, text, lang, source, *_ in docs:
        source, lang = source or "", lang or ""
        leaves[t.domains.get(source, t.other), lang, source].append(("" if i is None else str(i), len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    weights = lambda path: [getattr(t, n).get(x, t.default) for n, x in zip(mixing.LEVELS, path)]
    size = {p: sum(n for _, n in d) for p, d in leaves.items() if sum(n for _, n in d) and all(weights(p))}
    room = lambda path: sum(n for p, n in size.items() if p[: len(path)] == path) * t.epochs
    amounts = {(): min(sum(size.values()) * t.share // 1000, room(()))}
    for depth in (1, 2, 3):
        paths = {p[:depth] for p in size}
        for parent in {p[:-1] for p in paths}:
            own = [p for p in paths if p[:-1] == parent]
            amounts |= slow_fill({p: (weights(p)[depth - 1], room(p)) for p in own}, amounts[parent])
    out = []
    for leaf, n in size.items():
        full, rest = divmod(amounts[leaf], n)
        key = lambda i: hashlib.md5(f"{t.seed}:{full}:{i}".encode()).hexdigest()  # noqa: B023, E731
        taken, used = set(), 0
        for k in sorted({key(i) for i, _ in leaves[leaf]}):
            used += sum(n for i, n in leaves[leaf] if key(i) == k)
            if used > rest:
                break
            taken.add(k)
        if not rest:
            taken = set()
        out += [(i, leaf[0], full + (key(i) in taken)) for i, _ in leaves[leaf] if full + (key(i) in taken)]
    return sorted(out)


@pytest.mark.parametrize("share", [10, 300, 1000, 2600, 9000])
def test_mixture_equals_brute_force(table, share):
    rng = random.Random(share)
    docs = [(i, prose(i, rng.randint(0, 60)), rng.choice(["en", "de", None]), f"src{rng.choice([1, 1, 1, 2, 3, 4])}", 1) for i in range(200)]
    docs += docs[:5] + [(None, "a b c", "en", None, 1)]
    t = mixing.Targets({"src1": "web", "src2": "web", "src3": "books"}, {"web": 5, "books": 3}, {"en": 4, "de": 1}, {"src2": 3}, share=share, epochs=3)
    got = sorted(("" if r["doc_id"] is None else str(r["doc_id"]), r["domain"], r["copies"]) for r in mixing.mix(table(docs), t).collect())
    assert got == slow_mix(docs, t)


def test_mixture_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    for name, sql in queries.ORACLES.items():
        assert difference(queries.QUERIES[name](spark, folder), database(folder), sql) is None


def test_mixture_leaves_out_children_without_weight(table):
    docs = [(i, "a b c d", "en", f"src{i % 3}", 1) for i in range(30)]
    t = mixing.Targets(source={"src0": 0}, share=5000, epochs=2)
    got = mixing.mix(table(docs), t).collect()
    assert {r["source"] for r in got} == {"src1", "src2"} and {r["copies"] for r in got} == {2}


def test_mixture_of_odd_rows(odd, odd_rows, empty):
    got = mixing.mix(odd, mixing.Targets(share=4000))
    assert got.columns == [*odd.columns, "domain_", "copies_"]
    ids = Counter(r["doc_id"] for r in got.collect())
    assert ids[1] == 2 and {r["domain"] for r in got.collect()} == {"extra domain"}
    assert mixing.mix(empty).collect() == []


# The pipeline


def test_pipeline(spark, table, tmp_path):
    folder = str(tmp_path)
    item = prose(77, 40)
    base = [(i, prose(i, 80 + i % 5), ["en", "de", "fr"][i % 3], f"src{i % 9}", 1) for i in range(60)]
    passage = prose(500, 60)
    extra = [
        (100, "### " * 100, "en", "src1", 1),  # no words worth keeping
        (101, base[3][1], "en", "src2", 1),  # a copy
        (102, prose(102, 60) + " " + passage, "en", "src2", 1),
        (103, prose(103, 60) + " " + passage, "en", "src2", 1),  # a repeated passage
        (104, prose(104, 60) + " " + item, "de", "src4", 1),  # a leak
        (105, "too short", "de", "src4", 1),
        (None, prose(106, 100), None, None, None),
        (107, None, "en", "src1", None),
    ]
    table(base + extra).write.parquet(f"{folder}/documents.parquet")
    table([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        docs = stage(step(spark, docs, folder), f"step{i}")
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left.append({r["doc_id"]: r["text"] for r in docs.collect()})
    everyone = {r[0] for r in base + extra}
    assert set(left[0]) == everyone - {100, 105, 107}
    assert set(left[1]) == set(left[0]) - {101}
    assert set(left[2]) == set(left[1])
    assert left[2][102] == extra[2][1] and passage[:-1] not in left[2][103] and prose(103, 60)[:-1] in left[2][103]
    cut = slow_repeats([left[1][i] for i in sorted(left[1], key=lambda i: (i is not None, i or 0))], 100)
    assert [left[2][i].encode() for i in sorted(left[2], key=lambda i: (i is not None, i or 0))] == [c[3] for c in cut]
    assert set(left[3]) == set(left[2]) - {104}
    assert set(left[4]) <= set(left[3]) and len(left[4]) > 20
    assert rows(corpus_pipeline.run(spark, folder)) == rows(docs)


def write_tables(folder, docs, bench, table):
    docs.write.parquet(f"{folder}/documents.parquet")
    table(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_on_an_empty_table(spark, table, empty, tmp_path):
    write_tables(tmp_path, empty, [], table)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), "empty-step")
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_extra_columns_and_handle_repeated_rows(spark, table, odd, odd_rows, tmp_path):
    """Clashing names, nulls in any column and rows that occur many times go through every stage."""
    item = prose(77, 40)
    more = table([(50, prose(50, 90) + " " + item, "en", "src1", 1)] * 3 + [(51, prose(51, 120), "en", "src1", 1)] * 200 + [(None, prose(52, 120), "en", None, 1)] * 5)
    names = [c for c in odd.columns if c not in more.columns]
    docs = stage(odd.unionByName(more.withColumns({c: F.lit(f"extra {c}") for c in names})), "odd-pipeline")
    write_tables(tmp_path, docs, [(1, item)], table)
    kept = []
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = stage(step(spark, docs, str(tmp_path)), "odd-step")
        if i < 4:
            assert docs.columns == columns
            assert {r["__row"] for r in docs.collect()} == {"extra __row"}
        kept.append(Counter(r["doc_id"] for r in docs.collect()))
    assert kept[0][51] == 200 and kept[0][50] == 3 and kept[0][3] == 0
    assert kept[1][51] == 1 and kept[1][50] == 1 and kept[1][1] == 1 and kept[1][2] == 0
    assert kept[2] == kept[1] and kept[3][50] == 0 and sum(kept[3].values()) == sum(kept[2].values()) - 1
    assert set(kept[4]) <= set(kept[3])


@pytest.mark.parametrize("heavy", [1, 1000])
def test_a_fingerprint_that_a_third_of_all_rows_share(table, monkeypatch, heavy):
    monkeypatch.setattr(simhash, "HEAVY_ROWS", heavy)
    docs = [(i, prose(i, 40)) for i in range(200)] + [(1000 + i, prose(7, 40)) for i in range(100)] + [(None, prose(8, 40))] * 40
    got = simhash.near_copies(table(docs)).collect()
    fps = {t: slow_fingerprint(t) for _, t in docs}
    roots, least = slow_roots(list(fps.values()), 2), {}
    for i, t in docs:
        least[roots[fps[t]]] = min((x for x in (least.get(roots[fps[t]]), i) if x is not None), default=None)
    assert rows(simhash.near_copies(table(docs))) == sorted([(i, f"{fps[t]:016x}", least[roots[fps[t]]]) for i, t in docs], key=str)
    assert len(got) == len(docs) and simhash.keep_one(table(docs)).count() == len(set(roots.values()))


def test_only_revisit_records_look_for_their_response(table):
    pages = table([(i, f"http://a/{i}", "same" if i % 3 == 0 else f"page {i}") for i in range(90)], PAGES)
    found = warc.archive_pages(pages)
    got = {r["page_id"]: r for r in found.collect()}
    assert all((r["record_type"], r["refers_to"]) == (("revisit", 87) if i % 3 == 0 and i != 87 else ("response", None)) for i, r in got.items())
    assert all(r["payload_bytes"] == len("same" if i % 3 == 0 else f"page {i}") for i, r in got.items())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "type#" in plan
