"""Periodic runs, conversation repair and licence scans against plain Python, on given tables and on made rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import CLASH, LOWER, SCHEMA, WORD, corpus, prose, with_clashes

from dayledger.llm import licences, repair, repeats
from dayledger.llm.queries import QUERIES
from dayledger.llm.words import mix

SMALL = "/root/testdata/sf0.001"


def by_id(df, key):
    return Counter(tuple(r) for r in df.collect())


# periodic runs


def runs_of(words, power=4, least=6):
    """Every period in turn, smallest first."""
    found, number = {}, {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    for p in range(1, len(ids) // power + 1):
        edge = np.diff(np.concatenate([[0], (ids[:-p] == ids[p:]).astype(np.int8), [0]]))
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            if j + p - i >= max(least, power * p):
                found.setdefault((i, j + p), p)
    return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs_row(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = runs_of(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, sha(lines), sha(collapsed(words, runs)))


def test_runs_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    want = Counter(runs_row(r.doc_id, r.text) for r in docs.collect())
    assert sum(n for r, n in want.items() if r[1]) > 5
    assert by_id(QUERIES["op11_periodic_runs"](spark, SMALL), "doc_id") == want


def test_runs_of_odd_texts(spark):
    rows = [*corpus(), (900, "la " * 5, "en", "a", 1), (901, "la " * 6, "en", "a", 1), (902, "a b " * 4 + "a", None, None, None), (903, ("x y z " * 5).strip() + "\x0bx", "en", "a", 1)]
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in repeats.periodic_runs(docs).collect())
    words = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    assert got == Counter((i, len(w), tuple(runs_of(w)), collapsed(w, runs_of(w))) for i, w in words)
    assert by_id(repeats.runs_report(docs), "doc_id") == Counter(runs_row(r[0], r[1]) for r in rows)
    empty = repeats.runs_report(docs.limit(0))
    assert empty.count() == 0 and "exponent_milli" in empty.columns


@pytest.mark.parametrize("slice_words", [3, 17, 1 << 20])
def test_catchers_on_few_letters(monkeypatch, slice_words):
    """Words come in slices of any size; texts do not run into each other."""
    monkeypatch.setattr(repeats, "SLICE_WORDS", slice_words)
    rnd = random.Random(slice_words)
    for _ in range(60):
        power, texts = rnd.choice([2, 3, 4]), []
        for _ in range(rnd.randint(1, 6)):
            letters = rnd.randint(1, 3)
            text = [rnd.randint(0, letters) for _ in range(rnd.randint(0, 90))]
            for _ in range(rnd.randint(0, 3)):
                some = [rnd.randint(0, letters) for _ in range(rnd.randint(1, 15))]
                at = rnd.randint(0, len(text))
                text[at:at] = (some * 8)[: rnd.randint(1, 8 * len(some))]
            texts.append(text)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        hashes = mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(9))
        want = [(s + int(a), n, p) for t, a in zip(texts, first, strict=False) for s, n, p in runs_of(t, power)]
        assert [tuple(r) for r in repeats.find_runs(hashes, first, power, 6).tolist()] == want


def test_runs_that_only_look_equal_are_sought_again():
    words = [b"a", b"b"] * 8 + [b"c"] + [b"a", b"b"] * 5
    numbers = {w: mix(np.array([k], np.uint64))[0] for k, w in enumerate([b"a", b"b", b"c"])}
    hashes = np.array([numbers[w] for w in words], np.uint64)
    wrong = np.array([[0, len(words), 2]])
    assert [tuple(r) for r in repeats.checked_runs(words, wrong, hashes, 4, 6).tolist()] == runs_of(words)


def test_long_periodic_text_takes_few_comparisons():
    """A word 300,000 times, and a text whose prefixes agree by parity of bits, which defeats hashes modulo 2^64."""
    same = np.full(300_000, 5, np.uint64)
    assert repeats.find_runs(same, np.array([0, len(same)]), 4, 6).tolist() == [[0, 300_000, 1]]
    parity = np.array([bin(i).count("1") % 2 for i in range(1 << 13)], np.uint64)
    twice = np.tile(mix(parity + np.uint64(3)), 4)
    assert repeats.find_runs(twice, np.array([0, len(twice)]), 4, 6).tolist() == [[0, len(twice), 1 << 13]]
    assert len(repeats.find_runs(mix(parity + np.uint64(3)), np.array([0, 1 << 13]), 4, 6)) == 0


# conversations

SAID = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit) by taking the least (cost, audit) first; rows are (initial, must go, truncated)."""
    queue, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (repair.START, repair.ASSISTANT):
            return cost, audit
        need = repair.NEEDS[state]
        steps = [("I", 2, i, repair.AFTER[need])]
        if i < len(rows):
            initial, go, cut = rows[i]
            steps.append(("D", 3, i + 1, state))
            if not go:
                steps.append(("R", 2 + cut, i + 1, repair.AFTER[need]))
                if initial == need or (initial == "s" and state == repair.START):
                    steps.append(("K", int(cut), i + 1, repair.AFTER[initial]))
        for e, c, j, s in steps:
            heapq.heappush(queue, (cost + c, audit + e, j, s))


def report_row(conv, rows):
    """rows: (turn, role, text) after damage, in any order."""
    say = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, say(r)))
    seen, faults, steps = set(), Counter(), []
    for turn, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        steps.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(steps)
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:], strict=False))
    out, at, state = [], iter(rows), 0
    for e in audit:
        row = None if e == "I" else next(at)
        if e == "D":
            continue
        role = row[1] if e == "K" else {"u": "user", "a": "assistant"}[repair.NEEDS[state]]
        out.append(f"{role}:{row[2] if row else ''}")
        state = repair.AFTER[role[0]]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected_reports(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        part = lambda v: " " if v is None else str(v)
        h = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        here = convs[conv]
        role, text = (" " if role is None else role), (" " if text is None else text)
        if h:
            line = (turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            here.extend([line] * (2 if h == 3 else 1))
    return Counter(report_row(c, r) for c, r in convs.items())


def odd_conversations():
    rnd = random.Random(8)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "umpire"]
    texts = ["Yes.", "No", "Well?  \n", "", " \t\x0b", None, "Yes.", "Éh!", "a. b", prose(1, 40) + "."]
    rows = [(c, rnd.choice([t, t, t, t + 3, None, 0]), rnd.choice(roles), rnd.choice(texts)) for c in range(60) for t in range(rnd.randint(1, 9))]
    rows += [(None, t, "user", "Null id.") for t in range(3)] + [(500, None, "user", "One.")] * 5 + [(501, 1, "assistant", "Copy.")] * 40
    return rows + [(502, t, ("user", "assistant")[t % 2], f"Turn {t % 7}.") for t in range(-5, 300)]


@pytest.mark.parametrize("segment_rows", [3, 4096])
def test_repair_of_odd_conversations(spark, monkeypatch, segment_rows):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment_rows)
    rows = odd_conversations()
    df = with_clashes(spark.createDataFrame(rows, SAID).repartition(5))
    assert by_id(repair.repair_report(df), "conv_id") == expected_reports(rows)
    assert repair.repair_report(df.limit(0)).count() == 0


def test_repair_of_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = expected_reports(rows)
    assert len(want) > 50
    assert by_id(QUERIES["op12_conversation_repair"](spark, folder), "conv_id") == want


def test_repaired_rows_follow_the_pattern(spark):
    rows = [(c, t, r, x) for c, t, r, x in odd_conversations() if c is not None]
    _, repaired = repair.repair(spark.createDataFrame(rows, SAID))
    convs = defaultdict(list)
    for r in repaired.orderBy("conv", "seg", "k").collect():
        convs[r.conv].append(r.role[0])
    assert convs and all(re.fullmatch("s?(ua)+", "".join(x)) for x in convs.values())


def test_segments_give_what_the_whole_gives():
    rnd = random.Random(4)
    for _ in range(300):
        rows = [(rnd.choice("suaux"), rnd.random() < 0.15, rnd.random() < 0.3) for _ in range(rnd.randint(0, 40))]
        parts, at = [], 0
        while at < len(rows):
            n = rnd.randint(1, 9)
            costs, texts, ranks = repair.outcomes(rows[at : at + n], (0, 1, 2, 3) if at else (0,))
            parts.append({"seg": len(parts), "costs": costs, "audits": texts, "ranks": ranks, "illegal": 0, "first": "", "last": ""})
            at += n
        cost, _, picks = repair.chosen(parts)
        audit = "".join(p["audits"][e * 4 + x] + tail for p, (_, e, x, tail) in zip(parts, picks, strict=True))
        assert (cost, audit) == cheapest(rows)


def test_audits_with_hashes_that_all_collide():
    audits, rnd = repair.Audits(), random.Random(2)
    nodes, texts = [0], [""]
    for _ in range(300):
        k, e = rnd.randrange(len(nodes)), rnd.choice("DIKR")
        nodes.append(audits.add(nodes[k], e))
        texts.append(texts[k] + e)
    for honest in (True, False):
        if not honest:
            audits.hash = [7] * len(audits.hash)
        for _ in range(2000):
            i, j = rnd.randrange(301), rnd.randrange(301)
            sign = audits.compare(nodes[i], nodes[j])
            assert (sign > 0) - (sign < 0) == (texts[i] > texts[j]) - (texts[i] < texts[j])


# licences

LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_of(text):
    words = LICENCE_WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        places.extend((k, label) for k in range(len(words)) if words[k : k + len(p)] == p)
    labels = ",".join(sorted({label for _, label in places}))
    at = [k for k, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), labels


def check_licences(df, rows):
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect())
    assert got == Counter((i, *base_of(x)) for i, x in rows)
    for r in df.collect():
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(r.labels.split(",")))) and (r.score == 1.0 or not r.n_base)


def test_licences_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sum(base_of(x)[1] for _, x in rows) > 10
    check_licences(QUERIES["op13_licence_scan"](spark, "/root/testdata/sf0.01"), rows)


def test_licences_of_odd_texts(spark):
    notice = licences.TEMPLATES["mit"]
    cut = notice.split()
    changed = " ".join([*cut[:30], "whatever", "else", *cut[33:70], *cut[75:]])
    apart = " ".join(cut[:40]) + " " + prose(3, 400) + " " + " ".join(cut[40:])
    extra = [
        (800, f"{prose(1, 50)} {notice.upper()} {prose(2, 50)}"), (801, changed), (802, " ".join(cut[:20])), (803, apart),
        (804, "MIT\nLicense mit-license, GNU General Public License; cc.by CC BY cc by"), (805, "the gnu general public"), (806, "mit licensé 二 license"),
        (807, "Licensed under CC BY-NC 4.0."), (808, "by any means of the license"), (809, "mit license " * 3000),
    ]
    rows = [*corpus(), *[(i, x, "en", "a", len(x)) for i, x in extra]]
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    report = licences.licence_report(docs)
    check_licences(report, [(r[0], r[1]) for r in rows])
    labels = {r.doc_id: (r.labels, r.score) for r in report.filter("doc_id >= 800").collect()}
    assert labels[800] == ("mit", 1.0) and labels[801][0] == "mit" and 0.8 < labels[801][1] < 1
    assert labels[802][0] == "" and labels[805][0] == "" and labels[806][0] == "" and labels[808][0] == ""
    assert labels[807][0] == "cc-by,cc-by-nc" and labels[809][0] == "mit"
    spans = {r.doc_id: r.spans for r in licences.scan_licences(docs).filter("doc_id in (800, 803)").collect()}
    (span,) = [s for s in spans[800] if s.label == "mit"]
    assert (span.start, span.end) == (50, 50 + len(licences.words_of(notice))) and span.covered == 1.0
    assert all(s.covered < 0.9 for s in spans[803])
    assert licences.licence_report(docs.limit(0)).count() == 0


def test_automaton_and_chains_against_all_runs():
    templates, phrases = {"x": "a b a b c", "y": "b c a a b", "z": "c c c a"}, {"a b": "ab", "b c a": "bca"}
    machine = licences.Automaton(templates, phrases)
    seqs = [t.split() for t in [*templates.values(), *phrases]]
    number = {w.decode(): k for k, w in enumerate(machine.vocabulary)}
    rnd = random.Random(1)
    stands = lambda s, run: [e for e in range(len(s) - len(run) + 1) if s[e : e + len(run)] == run]
    for _ in range(500):
        words = [rnd.choice("abcd") for _ in range(rnd.randint(0, 15))]
        for i, (at, n) in enumerate(machine.statistics([number.get(w, len(number)) for w in words])):
            want = max(k for k in range(i + 2) if not k or any(stands(s, words[i + 1 - k : i + 1]) for s in seqs))
            assert n == want
            if n:
                run = words[i + 1 - n : i + 1]
                assert sorted(machine.states[at].ends) == sorted((k, e + n) for k, s in enumerate(seqs) for e in stands(s, run))
                assert sorted(b for m, b in machine.states[at].phrases if m <= n) == sorted(b for p, b in phrases.items() if run[-len(p.split()) :] == p.split())
    for _ in range(500):
        matches = sorted((rnd.randint(0, 30), rnd.randint(0, 30), rnd.randint(1, 6)) for _ in range(rnd.randint(1, 12)))
        best = []
        for a, o, n in matches:
            best.append(n + max((v for v, (b, p, m) in zip(best, matches, strict=False) if b + m <= a and p + m <= o), default=0))
        assert licences.best_chain(matches)[0] == max(best)


def test_long_texts_pass(spark):
    """A text of 12 MB in one row, beside a short one."""
    rows = [(1, prose(1, 20000) + " la" * 3_900_000), (2, "mit license")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs]) for r in repeats.periodic_runs(docs).select("doc_id", "n_words", "runs").collect()}
    assert got == {1: (3_920_000, [(20000, 3_900_000, 1)]), 2: (2, [])}
    assert {r.doc_id: r.n_base for r in licences.licence_report(docs).collect()} == {1: 0, 2: 1}


def test_names_of_the_caller_do_not_clash(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], SAID).withColumns({c: F.lit(1) for c in CLASH})
    assert repair.repair_report(df).select("conv_id", "cost", "audit").collect() == [(1, 0, "KK")]
