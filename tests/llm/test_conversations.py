"""Language identification, the prefix trie and the repair of conversations, against plain Python."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortspark.llm import language, repair, tries
from cohortspark.llm.common import Scratch

ROWS = "conv_id bigint, turn bigint, role string, text string, symbol string, pos int, name binary, words string, depth int"


def conversations(spark, rows):
    """Turns with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", 1, b"y", "z", 2) for r in rows], ROWS)


# --- 11: language -------------------------------------------------------------------------------------------------

TEXTS = [
    ("en", "the cat and the dog and the bird"),
    ("en", "there is the thing"),
    ("de", "der Hund und die Katze und der Vogel"),
    ("de", "das Ding ist über dem Haus; STRASSE"),
    ("fr", "le chat et le chien et l'oiseau été"),
    ("fr", None),
    (None, "the nobody counts"),
]
ASKED = [
    None, "", " \t\n", "123 ... ½", "the", "THE Hund", "katzenhund unddie", "中文", "le", "q",
    "the der", "été über", "und " * 30_000, "x" * 100_000, "thé",
]


def plain_language(pairs, text, entries=language.MODEL_ENTRIES, lengths=language.LENGTHS):
    word = re.compile(r"[^\W\d_]+́?")
    counts = defaultdict(Counter)
    for lang, t in pairs:
        if lang is not None and t is not None:
            for w in word.findall(t.lower()):
                counts[0, lang][w] += 1
                for n in lengths:
                    counts[n, lang].update(language.grams(w, n))
    langs = sorted({lang for _, lang in counts})
    kept = {}
    for key, c in counts.items():
        sizes = sorted(c.values(), reverse=True)
        ok = [n for n in set(sizes) if sum(s >= n for s in sizes) <= entries // len(langs)]
        kept[key] = {w: n / sum(sizes) for w, n in c.items() if ok and n >= min(ok)}

    def gain(key, w):
        p = kept.get(key, {}).get(w)
        return 0 if p is None else max(1, round(1e6 * (7 + math.log10(p))))

    words = word.findall((text or "").lower())
    if not [w for w in words if re.search(r"[^\W\d_½]", w)] or not langs:
        return "und", 0.0
    total, counted = Counter({lang: 0 for lang in langs}), 0
    for w in words:
        for n in (0, *lengths):
            units = [w] if n == 0 else [g for g in language.grams(w, n)]
            units = [u for u in units if any(u in kept.get((n, lang), {}) for lang in langs)]
            if units:
                counted += 1
                for lang in langs:
                    total[lang] += sum(gain((n, lang), u) for u in units) // len(units)
                break
    if not counted:
        return max(langs, key=lambda x: (sum(counts[0, x].values()), [-ord(c) for c in x])), 1 / len(langs)
    best = min(langs, key=lambda x: (-total[x], x))
    return best, 1 / sum(10 ** ((total[x] - total[best]) / (1e6 * counted)) for x in langs)


@pytest.mark.parametrize("entries", [language.MODEL_ENTRIES, 15, 0])
def test_language_against_plain_python(spark, entries):
    labelled = spark.createDataFrame(TEXTS, "lang string, text string")
    model = language.fit(labelled, entries=entries)
    assert model.languages == ("de", "en", "fr")
    docs = spark.createDataFrame([(i, t, "odd", 1) for i, t in enumerate(ASKED)], "doc_id bigint, text string, lang_pred string, score int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    for i, t in enumerate(ASKED):
        lang, score = plain_language(TEXTS, t, entries)
        assert got[i][0] == lang and got[i][1] == pytest.approx(score), (t or "")[:40]


def test_language_of_empty_tables_null_ids_and_too_many_labels(spark, monkeypatch):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = language.fit(none)
    assert language.identify(none, model).collect() == []
    rows = spark.createDataFrame([(None, "the cat", "en"), (None, "the cat", "en")], none.schema)
    assert [tuple(r) for r in language.identify(rows, model).collect()] == [(None, "und", 0.0)] * 2
    assert [r.lang_pred for r in language.identify(rows, language.fit(rows)).collect()] == ["en", "en"]
    monkeypatch.setattr(language, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        language.fit(rows.unionByName(rows.withColumn("lang", F.lit("de"))))


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language.fit(docs.filter(~held))
    out = language.identify(docs.filter(held), model, "doc_id", "text", F.col("lang").alias("told"))
    right = out.filter("lang_pred <> 'und'").agg(F.avg((F.col("told") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


# --- 12: prefix trie ----------------------------------------------------------------------------------------------


def plain_trie(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in below if not any(len(o) == len(n) + 1 and o[: len(n)] == n for o in below)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(node))
        out.append(
            (
                min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
                sum(len(n) == len(node) + 1 for n in below), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def sequences_of(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(ts)] for c, ts in turns.items()}


def trie_rows(seed):
    rng = random.Random(seed)
    rows = [(None, 0, "user", "nobody"), (3, None, None, None), (3, 1, "user", "a"), (3, 1, "user", "a"), (2, 0, "user", "")]
    rows += [(c, t, "u", "one two  three" if t % 3 else "x") for c in (10_000, 10_001, -7, 9) for t in range(21 if c % 2 else 34)]
    for c in range(100, 160):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c"])) for t in range(rng.choice([1, 2, 3, 5, 6]))]
    return rows


def trie(spark, rows):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    with Scratch(spark) as scratch:
        members = rows.filter("conv_id is not null").select("conv_id").distinct()
        made = tries.prefix_trie(scratch.table(tries.turn_symbols(rows)), members, scratch)
        return sorted((tuple(r) for r in made.select(*columns).collect()), key=str)


def test_trie_against_plain_python(spark):
    rows = trie_rows(1)
    assert trie(spark, conversations(spark, rows)) == plain_trie(sequences_of(rows))


def test_trie_of_few_rows(spark):
    assert trie(spark, conversations(spark, [])) == []
    for rows in ([(5, 0, "user", "a b")], [(5, 0, "u", "a"), (6, 0, "u", "a")], [(c, 0, "u", str(c)) for c in range(5)]):
        assert trie(spark, conversations(spark, rows)) == plain_trie(sequences_of(rows))


def test_names_keep_role_and_text_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "1:a", "b")]
    assert trie(spark, conversations(spark, rows)) == plain_trie(sequences_of(rows))


# --- 13: repair ---------------------------------------------------------------------------------------------------


def plain_repair(initials, faults):
    """Cheapest edits by a search over (cost, audit), every edit tried from every place."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, made = heapq.heappop(heap)
        if at == len(initials) and re.fullmatch("(s?(ua)+)?", made):
            return cost, audit, made
        state = (at, made[-1:])
        if (state, cost, audit) in done:
            continue
        done.add((state, cost, audit))

        def go(letter, more, to, role):
            now = made + role
            if re.fullmatch("s?(ua)*u?", now):
                heapq.heappush(heap, (cost + more, audit + letter, to, now))

        if cost < 4 * len(initials) + 1:
            for r in "ua":
                go("I", 3, at, r)
        if at < len(initials):
            extra = 3 * (faults[at] == repair.TRUNCATED)
            go("D", 4, at + 1, "")
            if faults[at] in (repair.FINE, repair.TRUNCATED):
                if initials[at] in "sua":
                    go("K", extra, at + 1, initials[at])
                for r in "ua":
                    go("R", 3 + extra, at + 1, r)


def test_cheapest_against_a_search():
    rng = random.Random(5)
    for n in range(7):
        for _ in range(60):
            initials = "".join(rng.choice("suuaa-") for _ in range(n))
            faults = bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
            cost, audit, made = plain_repair(initials, faults)
            assert repair.cheapest(initials, faults) == (cost, audit), (initials, list(faults))
            names = {"s": "system", "u": "user", "a": "assistant", "-": "tool"}
            rows = [(names[i], str(k)) for k, i in enumerate(initials)]
            assert "".join(r[0] for r, _ in repair.repaired(rows, audit)) == made


def test_repair_of_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 4, "user", "No"), (1, 4, "user", "No"), (1, 5, "user", " \t"),
        (2, None, None, None), (2, 7, "tool", "x!"),
        (None, 1, "user", "a."), (None, 2, "assistant", "b."),
        (3, None, "user", "q?"), (3, None, "assistant", "z."),
    ]
    ids = spark.createDataFrame([(1,), (2,), (None,), (3,), (8,)], "conv_id bigint")
    got = {r.conv_id: r for r in repair.repair_conversations(conversations(spark, rows), ids).collect()}
    assert set(got) == {1, 2, 3, None, 8}
    r = got[1]
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == (2, 1, 1, 1, 2)
    assert (r.cost, r.audit) == (12, "KKDDD") and [tuple(t) for t in r.turns] == [("user", "Hi."), ("assistant", "Yes.")]
    assert (got[8].cost, got[8].audit, got[8].turns, got[8].gaps) == (0, "", [], 0)
    assert (got[None].cost, got[None].audit) == (0, "KK")
    assert got[3].gaps == 0 and got[3].audit == plain_repair("au", bytes(2))[1]
    assert (got[2].blank, got[2].gaps, got[2].cost, got[2].audit) == (1, 0, 8, "DD")
    assert repair.repair_conversations(conversations(spark, [])).collect() == []


def test_repair_of_a_long_conversation(spark):
    n = 2_000
    rows = [(1, t, "user" if t % 5 else "assistant", f"{t}." if t % 7 else "cut") for t in range(n)]
    r = repair.repair_conversations(conversations(spark, rows)).first()
    assert re.fullmatch("(ua)+", "".join(t.role[0] for t in r.turns)) and len(r.audit.replace("I", "")) == n
    kept = r.audit.count("K") + r.audit.count("R")
    assert kept + r.audit.count("I") == len(r.turns)


def test_damage(spark):
    rows = [(c, t, "assistant", "a.b!c?") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    import zlib

    want = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        out = (c, t, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))
        want[out] += {0: 0, 3: 2}.get(kind, 1)
    frame = repair.damaged(conversations(spark, rows))
    assert frame.columns == [c.split()[0] for c in ROWS.split(", ")]
    assert Counter(tuple(r)[:4] for r in frame.collect()) == +want
