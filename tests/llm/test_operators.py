"""The operators against their plain versions, on fixtures with the awkward cases and on a whole small table."""

from __future__ import annotations

import gzip
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from keytide.llm import decontaminate, license_scan, line_dedup, line_quality, mixing, near_dups  # noqa: E402
from keytide.llm import substring, token_codes, url_graph, warc  # noqa: E402
from keytide.llm.common import cut  # noqa: E402
from keytide.llm.graph import components  # noqa: E402
from keytide.llm.queries import tokenizer_path  # noqa: E402
from keytide.llm.storage import new_folder  # noqa: E402

# Extra columns with names that the operators use themselves.
SCHEMA = "doc_id long, text string, source string, words int, row string, node long, hash long, n int"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    made = [rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("klmnop") + str(rng.randrange(40)) for _ in range(n)]
    return "\n".join(" ".join(made[i : i + 12]) + "." for i in range(0, n, 12))


def fixture_rows():
    long = prose(1, 400)
    edited = long.replace(long.split()[5], "Other", 1).replace(long.split()[300], "Word", 1)
    some = [
        (1, long), (2, edited), (3, prose(2, 120) + "\n" + "\n".join(long.split("\n")[3:12])), (4, ""), (5, None), (6, " \n\t "),
        (7, "three small words"), (8, "Three SMALL words"), (9, prose(3, 200)), (10, prose(3, 200)),
        (11, "menu | home | about | login\n" * 30), (12, "x y z " * 60), (13, "é ü " + prose(4, 80) + " ñ ΑΒΓ İ"),
        (14, prose(5, 60) + "\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0."),
        (15, "cc by nc cc by nc\n" + prose(5, 60)), (16, long), (17, "### $$$ %%% " * 40), (18, prose(6, 3000)),
    ]
    return [(i, t, f"s{i % 3}" if i % 4 else None, 1, "r", 2, 3, 4) for i, t in some]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


@pytest.fixture(scope="module")
def pairs():
    return [(r[0], r[1]) for r in fixture_rows()]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, rows that repeat, and one id with two texts."""
    a, b = prose(1, 90), prose(2, 90)
    rows = [(None, a), (None, a), (1, a), (1, a), (1, b), (None, None), (2, b)]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_measures(docs, pairs):
    got = {r["row"]["doc_id"]: r for r in line_quality.judge(docs).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {i: tuple(got[i][n] for n in names) for i in got} == {i: brute.quality(t) for i, t in pairs}
    assert not any(r["kept"] and r["base_failed"] for r in got.values())
    assert got[1]["kept"] and got[18]["kept"] and not got[11]["kept"] and not got[17]["kept"]


def test_quality_filter_keeps_columns_and_cleans(spark, docs, none, odd):
    text = "menu | home | about\n" + prose(9, 100)
    one = spark.createDataFrame([(1, text, None, 1, "r", 2, 3, 4)], SCHEMA)
    kept = line_quality.keep_clean(one).collect()
    assert [r["text"] for r in kept] == [prose(9, 100)] and kept[0].asDict().keys() == set(docs.columns)
    assert line_quality.keep_clean(none).count() == 0 and line_quality.keep_clean(odd).count() == 6


def test_near_duplicates(docs, pairs, none, odd):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dups.near_duplicates(docs).collect()}
    assert got == brute.near(pairs)
    assert near_dups.keep_first(docs).columns == docs.columns
    assert near_dups.near_duplicates(none).count() == 0
    rows = sorted(((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_dups.near_duplicates(odd).collect()))
    assert rows == [(0, 0, True), (0, 1, False), (0, 1, False), (1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_large_regions_lose_no_links(spark, monkeypatch):
    """A group of variants, many alike to a few others only, in regions far larger than the reach."""
    monkeypatch.setattr(near_dups, "REACH", 1)
    rng = random.Random(17)
    base, rows = prose(21, 80).split(), []
    for i in range(160):
        made = list(base)
        for at in rng.sample(range(8, 72), 2):
            made[at] = f"new{rng.randrange(3)}"
        rows.append((i, " ".join(made)))
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near(rows)
    assert 1 < len({r["component_id"] for r in got}) < 160


def test_sets_meet_once_a_stretch_of_shingles(spark):
    """Two sets with many shingles in common make few rows before they are told apart."""
    rng = random.Random(23)
    draw = lambda n: [rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)]
    common = draw(320)
    rows = [(node, node, 360, common + draw(40), [0] * len(near_dups.BITS)) for node in range(2)]
    sets = cut(spark.createDataFrame(rows, "node long, root long, n int, tokens array<long>, bits array<long>"))
    met = line_dedup.entries_met(near_dups._spread(sets), "root", near_dups.BITS, near_dups.PART, None, "before").collect()
    assert {tuple(r) for r in met} == {(0, 1)} and len(met) < 4
    every = line_dedup.entries_met(near_dups._spread(sets), "root", near_dups.BITS, near_dups.PART, None, None)
    assert every.count() > 2 * len(met)


def test_partition_ends_keep_their_order():
    """A region over three partitions; its rows are neighbours only in the order of places."""
    ends = [(5, node, node) for node in (9, 2, 7, 1)]
    assert near_dups._boundary_pairs(ends, 1) == [(1, 7), (2, 7), (2, 9)]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 430)]
    label = {x: x for e in edges for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {x: m for x, m in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_leaks(spark, docs, pairs, none, odd):
    long = prose(1, 400)
    items = [(1, " ".join(long.split()[40:80])), (2, prose(8, 30)), (3, None), (4, ""), (5, "three small"), (6, " ".join(long.split()[0:30])), (6, "a b")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert got == pytest.approx(brute.leaks(pairs, items))
    left = decontaminate.drop_leaks(docs, benchmark)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in pairs} - {i for i, _ in got}
    assert left.columns == docs.columns
    assert decontaminate.find_leaks(none, benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(odd, benchmark).count() == 3


def test_leaks_with_far_fingerprints(spark):
    """Items with one word of 40 changed whose fingerprints happen to lie over 19 bits apart."""
    pairs = []
    for i in range(1500):
        made = prose(1000 + i, 40).split()
        pairs.append((i, " ".join(made), " ".join([*made[:20], "changed", *made[21:]])))
    frame = cut(spark.createDataFrame(pairs, "id long, a string, b string").repartition(4))
    hashed = [cut(decontaminate.with_hashes(frame.select("id", F.col(c).alias("text")), 5)) for c in ("a", "b")]
    prints = [h.select("id", decontaminate.fingerprint(F.col("hashes")).alias(c)) for h, c in zip(hashed, ("a", "b"))]
    far = prints[0].join(prints[1], "id").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 19)
    far = frame.join(far.select("id"), "id").collect()
    assert far
    items = spark.createDataFrame([(r["id"], r["a"]) for r in far], "item_id long, text string")
    changed = spark.createDataFrame([(r["id"], r["b"]) for r in far], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(changed, items).collect()}
    assert got == pytest.approx({(r["id"], r["id"]): 31 / 41 for r in far})


def test_fingerprint_blocks_miss_nothing(spark):
    """Every pair within the radius meets in a block; few pairs of chance do."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    flipped = [base]
    for n in range(decontaminate.RADIUS + 1):
        x = base
        for bit in rng.sample(range(64), n):
            x ^= 1 << bit
        flipped.append(x)
    values = [(i, x - (1 << 64) if x >= 1 << 63 else x) for i, x in enumerate(flipped)]
    rows = spark.createDataFrame(values, "id long, fingerprint long")
    meets = decontaminate.share_a_block(F.col("fingerprint"), F.lit(values[0][1]))
    assert rows.where(meets).count() == len(flipped)
    # A pair that differs in three bits of each block meets in none.
    apart = base ^ sum(0b111 << first for first, _ in decontaminate.blocks())
    rows = spark.createDataFrame([(0, apart - (1 << 64) if apart >= 1 << 63 else apart)], "id long, fingerprint long")
    assert rows.where(meets).count() == 0


def test_prints_part_unlike_texts(spark):
    """Texts with one word of 40 changed are within the radius and meet; few of chance do."""
    made = [prose(3000 + i, 40).split() for i in range(60)]
    rows = [(i, " ".join(m), " ".join([*m[:20], "changed", *m[21:]])) for i, m in enumerate(made)]
    frame = spark.createDataFrame(rows, "id long, a string, b string")
    sides = []
    for c in ("a", "b"):
        hashed = decontaminate.with_hashes(frame.select("id", F.col(c).alias("text")), 5)
        sides.append(cut(decontaminate.with_prints(hashed, f"{c}_prints").select(F.col("id").alias(c), f"{c}_prints")))
    x, y = F.col("a_prints"), F.col("b_prints")
    meets = sides[0].crossJoin(sides[1]).where(decontaminate.share_a_print(x, y))
    meets = meets.select("a", "b", decontaminate.bits_apart(x, y).alias("apart")).collect()
    assert {r["a"] for r in meets if r["a"] == r["b"] and r["apart"] <= decontaminate.WIDE_RADIUS} == set(range(60))
    assert len(meets) < 60 + 60 * 59 // 20


def test_only_shared_shingles_are_compared(spark, monkeypatch):
    """Windows meet the items they share shingles with, and no others of their length."""
    items = [(i, prose(100 + i, 30)) for i in range(40)]
    texts = [(i, prose(500 + i, 60) + "\n" + t) for i, t in items]
    cuts = []
    monkeypatch.setattr(decontaminate, "cut", lambda rows, real=decontaminate.cut: cuts.append(real(rows)) or cuts[-1])
    schema = "doc_id long, text string"
    leaks = decontaminate.find_leaks(spark.createDataFrame(texts, schema), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in leaks.collect()} == {(i, i) for i, _ in items}
    pairs = next(c for c in cuts if "start" in c.columns and "item_id" in c.columns)
    assert pairs.where("doc_id <> item_id").count() == 0


def test_repeats(docs, pairs, none, odd):
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    got = [tuple(r[n] for n in names) for r in substring.remove_repeats(docs).collect()]
    assert sorted(got) == sorted(brute.without_repeats(pairs))
    assert substring.remove_repeats(none).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = [tuple(r[n] for n in names) for r in substring.remove_repeats(odd).collect()]
    assert sorted(got, key=str) == sorted(brute.without_repeats(rows), key=str)


def test_licenses(docs, pairs, none, odd):
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert {i: tuple(got[i][n] for n in names) for i in got} == {i: brute.licenses(t, license_scan.BASE) for i, t in pairs}
    assert got[14]["labels"] == "apache-2,mit" and got[15]["labels"] == "cc-by-nc" and got[1]["labels"] == ""
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert license_scan.scan_licenses(none).count() == 0 and license_scan.scan_licenses(odd).count() == 7


def test_license_rules_hold_their_gates():
    """Each rule's keyword or name contains a word of the gate, so the gate loses nothing."""
    for _, _, _, keyword, pattern, _ in license_scan.rules():
        assert any(g in keyword for g in license_scan.GATE) or "licen[cs]e" in pattern or "licen[cs]ed" in pattern


@pytest.mark.parametrize("c", "cs")
def test_license_keywords_lose_no_spelling(c):
    """Each rule's keyword and one of its literals are in matches of either spelling."""
    for template in license_scan.TEMPLATES:
        for _, name in license_scan.NAMES:
            for option in license_scan.literals(name):
                text = " " + re.sub(r"\(\?:[^()]*\)\?", "", template[3].replace("(?:terms of (?:the )?)?", "")).replace("[cs]", c) + " "
                text = re.sub(r"\(\?:released\|[^)]*\)", "released", text).replace("{name}", option.strip())
                assert template[2] in text and option in text, text


def test_license_spellings(spark):
    texts = ["only licenced under the GPL", "Licence: MIT", "Licensed under GPLv2", "Licensed under GPL v3.0", "GPLv3 licence"]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["labels"] for r in sorted(rows, key=lambda r: r["doc_id"])] == ["gpl", "mit", "gpl-2", "gpl-3", "gpl-3"]


def test_licenses_named_alone(spark):
    """Names without a phrase around them, in either spelling."""
    expected = {
        "Mozilla Public License Version 2.0": "mpl-2", "The European Union Public License 1.2": "eupl-1.2", "GNU GPL": "gpl",
        "BSD-3-Clause": "bsd-3", "Apache-2.0": "apache-2", "released under MIT": "mit", "The Python License": "python-2",
        "GNU General Public Licence v3 or later": "gpl-3", "GPL-2.0-only": "gpl-2", "(LGPL-2.1)": "lgpl-2.1", "AGPLv3": "agpl-3",
        "see creativecommons.org/licenses/by-nc-sa/4.0": "cc-by-nc-sa", "CC0": "cc0", "Eclipse Public Licence 2.0": "epl-2",
    }
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(expected)), "doc_id long, text string")).collect()
    assert {list(expected)[r["doc_id"]]: r["labels"] for r in rows} == expected
    clean = ["a mit of wool under the bridge", "the bsdetector and gplaces", "an apache helicopter", "he made it available under pressure"]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")).collect()
    assert {r["labels"] for r in rows} == {""}


@pytest.mark.parametrize("rule", license_scan.HAND, ids=lambda r: r[3][:40])
def test_hand_written_rules_contain_their_keywords(rule):
    """Every text a pattern describes, by its parts taken and left out."""
    label, _, keyword, pattern = rule

    def spelled(p):
        """All texts of a pattern of groups, optional parts and classes."""
        done = [""]
        while p:
            if p.startswith("(?:"):
                depth, end = 0, 0
                for end, c in enumerate(p):
                    depth += (c == "(") - (c == ")")
                    if depth == 0:
                        break
                inner, p, options, part, depth = p[3:end], p[end + 1 :], [], "", 0
                for c in inner:
                    depth += (c == "(") - (c == ")")
                    if c == "|" and depth == 0:
                        options, part = [*options, part], ""
                    else:
                        part += c
                texts = [t for o in [*options, part] for t in spelled(o)]
            elif p[0] == "[":
                inner, _, p = p[1:].partition("]")
                texts = list(inner.replace("-", ""))
            else:
                texts, p = [p[0]], p[1:]
            if p.startswith("?"):
                texts, p = ["", *texts], p[1:]
            done = [d + t for d in done for t in texts]
        return done

    for text in spelled(pattern):
        assert re.fullmatch(pattern, text) and keyword in f" {text} "
        assert any(g in f" {text} " for g in license_scan.GATE)


def test_contained_license_goes(spark):
    text = "distributed under the terms of the GNU General Public License version 3. SPDX-License-Identifier: MIT"
    row = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert "mit" in row["labels"].split(",") and row["score"] == 1.0
    spans = [(d["start"], d["end"], d["priority"]) for d in row["detections"]]
    assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] for a in spans for b in spans)


def test_lines(docs, pairs, none, odd):
    got = {(r["doc_id"], r["line_no"]): r["removed"] for r in line_dedup.near_lines(docs).collect()}
    assert got == brute.later_lines(pairs)
    assert line_dedup.near_lines(none).count() == 0 and line_dedup.near_lines(odd).count() > 0
    assert {r["doc_id"] for r in line_dedup.drop_lines(docs).collect()} == {i for i, _ in got}


def test_line_links_are_all_counted(spark, monkeypatch):
    """Variants of one line, most of them matched by the first already; also with tokens cut into parts."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(16)]
    lines = [" ".join(w if rng.random() < 0.93 else f"v{rng.randrange(5)}" for w in base) for _ in range(60)]
    lines += lines[:5] + ["other words here", "another line of words"]
    pairs = [(None if i == 3 else i, "\n".join(lines[i::7])) for i in range(7)]
    frame = spark.createDataFrame(pairs, "doc_id long, text string")
    expected = brute.line_links([(-1 if i is None else i, t) for i, t in pairs])
    for hot in (line_dedup.HOT, 8):
        monkeypatch.setattr(line_dedup, "HOT", hot)
        rows = line_dedup.near_lines(frame).collect()
        got = {(-1 if r["doc_id"] is None else r["doc_id"], r["line_no"]): r for r in rows}
        assert {p: r["n_links"] for p, r in got.items()} == {p: n for p, (n, _) in expected.items()}
        match = {p: None if r["match_line"] is None else (-1 if r["match_doc"] is None else r["match_doc"], r["match_line"]) for p, r in got.items()}
        assert match == {p: m for p, (_, m) in expected.items()}
    assert max(n for n, _ in expected.values()) > 5


def variants(rng, base, n, changes, others):
    """``n`` lines of ``base`` with some words left out, replaced or added."""
    made = []
    for _ in range(n):
        line = list(base)
        for _ in range(rng.choice(changes)):
            k = rng.randrange(len(line))
            line[k : k + 1] = rng.choice([[], [rng.choice(others)], [rng.choice(others)], [line[k], rng.choice(others)]])
        made.append(" ".join(line))
    return made


def test_line_groups_link_without_pairs(spark, monkeypatch):
    """All variants of a line are alike; their links are counted, and no pair of them is made."""
    rng = random.Random(12)
    lines = variants(rng, [f"w{i}" for i in range(48)], 70, [1, 2], [f"v{i}" for i in range(900)])
    pairs = [(i, "\n".join(lines[i::5] + lines[i : i + 2])) for i in range(5)]
    made, verified = [], line_dedup._verified

    def watched(lines, ranks, classes, pairs, steps):
        made.append(pairs.count())
        return verified(lines, ranks, classes, pairs, steps)

    monkeypatch.setattr(line_dedup, "_verified", watched)
    rows = line_dedup.near_lines(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    expected = brute.line_links(pairs)
    assert {(r["doc_id"], r["line_no"]): r["n_links"] for r in rows} == {p: n for p, (n, _) in expected.items()}
    assert min(n for n, _ in expected.values()) >= 60 and made == [0]


@pytest.mark.parametrize("hot", [line_dedup.HOT, 8])
def test_line_groups_of_mixed_variants(spark, monkeypatch, hot):
    """Links that the distance to a group's centre tells and those that it does not, in groups with groups in them."""
    rng = random.Random(13)
    monkeypatch.setattr(line_dedup, "HOT", hot)
    base = [f"w{i}" for i in range(30)]
    near = variants(rng, base, 1, [4], ["x0", "x1", "x2"])[0].split()
    lines = variants(rng, base, 45, range(8), [f"v{i}" for i in range(12)]) + variants(rng, near, 30, range(6), [f"u{i}" for i in range(9)])
    lines += variants(rng, base[:9], 25, range(3), ["s", "t"]) + lines[:6] + ["one", "two words", ""]
    rng.shuffle(lines)
    pairs = [(None if i == 3 else i, "\n".join(lines[i::7])) for i in range(7)]
    told, uncounted = [], line_dedup._uncounted
    monkeypatch.setattr(line_dedup, "_uncounted", lambda members: told.append(uncounted(members).count()) or uncounted(members))
    rows = line_dedup.near_lines(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    expected = brute.line_links([(-1 if i is None else i, t) for i, t in pairs])
    got = {(-1 if r["doc_id"] is None else r["doc_id"], r["line_no"]): r for r in rows}
    assert {p: r["n_links"] for p, r in got.items()} == {p: n for p, (n, _) in expected.items()}
    match = {p: None if r["match_line"] is None else (-1 if r["match_doc"] is None else r["match_doc"], r["match_line"]) for p, r in got.items()}
    assert match == {p: m for p, (_, m) in expected.items()}
    assert told[0] > 0


def test_line_steps_leave_little(spark, docs, monkeypatch):
    """Places without prefixes and the named classes are all that stays of the steps."""
    folder = new_folder(spark, "test-lines")
    monkeypatch.setattr(line_dedup, "new_folder", lambda *_: folder)
    rows = line_dedup.near_lines(docs)
    assert {p.name for p in Path(folder.removeprefix("file://")).iterdir()} == {"places", "named"}
    assert spark.read.parquet(f"{folder}/places").columns == ["doc_id", "line_no", "k1", "k2"] and rows.count() > 0


def test_similar_sets_share_one_of_their_first_grams(spark):
    """Sets of 3 to 40 tokens and similar ones that lack some tokens, have others, or both; unlike lines with common tokens do not meet."""
    rng = random.Random(14)
    pairs = []
    for n in [*range(3, 41)] * 6:
        base = rng.sample([f"{'x' * rng.randrange(9)}{i}" for i in range(400)], n)
        gone = rng.randrange(n // 4 + 1)
        other = base[gone:] + [f"new{'y' * rng.randrange(9)}{i}" for i in range((4 * (n - gone) - 3 * n) // 3)]
        assert 4 * (n - gone) >= 3 * len({*base, *other})
        pairs += [(len(pairs) + i, " ".join(rng.sample(w, len(w)))) for i, w in enumerate((base, other))]
    rows = spark.createDataFrame(pairs, "doc_id long, line string").select("doc_id", line_dedup.numbers(F.col("line")).alias("tokens"))
    rows = {r["doc_id"]: r for r in rows.select("doc_id", "tokens", line_dedup.grams("tokens", F.size("tokens")).alias("grams")).collect()}
    for i in range(0, len(pairs), 2):
        assert {*rows[i]["grams"]} & {*rows[i + 1]["grams"]} or rows[i]["tokens"] == rows[i + 1]["tokens"]
        assert all(len(rows[i + k]["grams"]) <= len(rows[i + k]["tokens"]) // 2 + 1 for k in (0, 1))
    common = [("the of and to in a is it " + " ".join(f"{rng.choice('abcdefgh')}longer{rng.randrange(10**9)}" for _ in range(12)),) for _ in range(50)]
    spread = spark.createDataFrame(common, "line string").select(line_dedup.numbers(F.col("line")).alias("tokens"))
    spread = spread.select(F.explode(line_dedup.grams("tokens", F.size("tokens"))).alias("gram"))
    assert spread.groupBy("gram").count().where("count > 1").isEmpty()


def test_line_keys_that_clash_are_made_anew(spark, monkeypatch):
    keys, seeds = line_dedup._keys, []

    def clashing(tokens, seed):
        seeds.append(seed)
        k1, k2 = keys(tokens, seed)
        return [F.when(seed == 0, F.lit(1).cast("long")).otherwise(k1).alias("k1"), k2]

    monkeypatch.setattr(line_dedup, "_keys", clashing)
    lines = "one two three four five six seven\nother words\none two three four five six seven eight\nwords other"
    rows = line_dedup.near_lines(spark.createDataFrame([(1, lines)], "doc_id long, text string")).orderBy("line_no").collect()
    assert [(r["class_line"], r["match_line"], r["n_links"]) for r in rows] == [(0, None, 1), (1, None, 1), (2, 0, 1), (1, None, 1)]


def test_plain_lowers_a_to_z_only(spark):
    """Every code point by itself, and words that have both cases."""
    chars = spark.range(1, 0x110000).where("id not between 55296 and 57343")
    chars = chars.select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    changed = chars.where(line_dedup.plain(F.concat(F.lit("aB"), "c")) != F.concat(F.lit("ab"), "c")).select("c").collect()
    assert {r["c"] for r in changed} == {*"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\x0b\x0c\r"}


def test_mix_meets_targets(spark, none, odd):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.choice([3, 5, 5, 5, 20, 90])), rng.choice(["a", "b", "b", "c", None]), None, None, None, None, None) for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs, keep=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "copies").collect()
    again = mixing.mix(docs.repartition(7), keep=["doc_id", "source"]).select("row.*", "size", "source_size", "target", "copies").collect()
    assert sorted(got, key=str) == sorted(again, key=str) and len(got) == 600
    for source in ("a", "b", "c", None):
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["copies"] * r["size"] for r in mine) - mine[0]["target"]) <= 90
    assert max(r["copies"] for r in got) <= 2
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(1.5 * sum(r["size"] for r in got))
    assert mixing.repeat(docs).count() == sum(r["copies"] for r in got) and mixing.repeat(docs).columns == docs.columns
    assert mixing.mix(none).count() == 0 and mixing.mix(odd).count() == 7


@pytest.mark.parametrize("long", [0, 40_000])
def test_mix_is_tilted_by_size(spark, long):
    """Rates of five sources, among them empty documents and one that holds most of its source."""
    rng = random.Random(long)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 31, 200])), rng.choice("abcd"), None, None, None, None, None) for i in range(400)]
    rows += [(1000, "w " * long, "b", None, None, None, None, None), (1001, "", "empty", None, None, None, None, None)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), keep=["doc_id", "source"]).select("row.*", "size", "target", "rate", "copies").collect()
    varied = 0
    for source in ("a", "b", "c", "d", "empty"):
        mine = [r for r in got if r["source"] == source]
        plain = brute.tilted_rates([r["size"] for r in mine], mine[0]["target"])
        assert [r["rate"] for r in mine] == pytest.approx(plain, abs=1e-6)
        assert sum(r["rate"] * r["size"] for r in mine) == pytest.approx(mine[0]["target"])
        varied += len({r["rate"] for r in mine}) > 2
    # The others are at their limit of two copies if one source holds nearly all.
    assert varied >= (1 if long else 2) and all(abs(r["copies"] - r["rate"]) < 1 + 1e-6 for r in got)


def test_mix_of_a_whole_table_is_near_its_targets(spark):
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), keep=["source"])
    sources = got.groupBy("row.source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"))
    for r in sources.collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.005)


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [0, 5, 5], [1, 1000, 3, 3]])
def test_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    found = mixing.targets(sizes, weights, 1.5, 2.0)
    assert found.sum() == pytest.approx(1.5 * sum(sizes)) and (found <= 2.0 * np.array(sizes) + 1e-9).all()


def test_tokens_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    extra = spark.createDataFrame([(None, "last one <|endoftext|> it's 2024!", None, 0, "", 0, 0, 0)], SCHEMA)
    docs = docs.unionAll(extra)
    files = token_codes.write_tokens(docs, new_folder(spark, "test-tokens"), tokenizer_path())
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_codes.read_tokens(files).collect()}
    start, expected, every = 0, {}, []
    for i, text in sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start, every = start + len(ids), every + ids
    assert got == expected
    for row in files.collect():
        file = token_codes.TokenFile(row["path"])
        for i in [*range(0, row["n_tokens"], 97), row["n_tokens"] - 1]:
            assert file.token(i) == every[row["start"] + i]
        assert file.document(0) == file.all_ids()[: file.ends()[0]].tolist()
    assert token_codes.read_tokens(token_codes.write_tokens(none, new_folder(spark, "test-tokens"), tokenizer_path())).count() == 0


def test_words_are_encoded_as_the_library_does(monkeypatch):
    """Words in other cases and with marks are known ones; what is not plain stays as it is, and few words stay known."""
    from tokenizers import Tokenizer

    tokenizer, made = Tokenizer.from_file(tokenizer_path()), token_codes.WordEncoder(tokenizer_path())
    texts = [
        "Some words, SOME Words. some? words!", "it's Fine. DON'T, x.. y., 'S a3. 3a, 12. ; .", "<|ENDOFTEXT|> Ab. <|startoftext|>Ab, cD.", "",
        "Σίσυφος ΑΣ. \u0130stanbul \u212bA\u030a, KK. é. e.\u0301 straße, Über, über. ß. ÿ; ÷.", "a.\x1c b\x85. b,\u00a0c. A.\x0bb,\x0c",
    ]
    for limit in (token_codes.CACHE_WORDS, 3):
        monkeypatch.setattr(token_codes, "CACHE_WORDS", limit)
        for text in [*texts, *texts[::-1]]:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            assert made.encode([text.encode()]) == [np.array(ids, "<u4").tobytes()], text
    assert len(made.known) <= max(3, len(texts[0].split()))
    made = token_codes.WordEncoder(tokenizer_path())
    made.encode([texts[0].encode()])
    assert set(made.known) == {b"some", b"words", b",", b".", b"?", b"!"}


def test_words_before_runs_of_marks_are_known_ones():
    """Marks of any number are set off, and words that come again stay known when others go."""
    from tokenizers import Tokenizer

    tokenizer, made = Tokenizer.from_file(tokenizer_path()), token_codes.WordEncoder(tokenizer_path())
    texts = ["Words### words,$$$ é.*** words", "###words a'##b ##'s ab'## é'' a-b -- -a (a) [é]_ <|b|>", "#", "a#", "É##", "#a", "a=\u0338 a>\u0338 #\u0301", "x" + "#" * 3000]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert made.encode([text.encode()]) == [np.array(ids, "<u4").tobytes()], text
    made = token_codes.WordEncoder(tokenizer_path())
    made.encode([texts[0].encode()])
    assert set(made.known) == {"words".encode(), "é".encode(), b"###", b",$$$", b".***"}


def test_words_that_come_again_stay_known(monkeypatch):
    made, asked = token_codes.WordEncoder(tokenizer_path()), []
    ids = made.known.make
    made.known.make = lambda word: asked.append(word) or ids(word)
    monkeypatch.setattr(token_codes, "CACHE_WORDS", 40)
    for text in [b"the word%s a" % (b"x" * i) for i in range(200)] * 2:
        made.encode([text])
        assert len(made.known) + len(made.known.older) <= 2 * (20 + 3)
    assert asked.count(b"the") == asked.count(b"a") == 1 and len(asked) == 402


def test_wide_ids_pack():
    ids = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1] * 300, dtype=np.uint32)
    path = "/tmp/keytide-test-wide.dac"
    token_codes.write_whole(path, token_codes.pack(ids, np.array([1]), np.array([0]), np.array([len(ids)])))
    file = token_codes.TokenFile(path)
    assert (file.all_ids() == ids).all() and [file.token(i) for i in range(0, len(ids), 131)] == ids[::131].tolist()


def test_archives(spark):
    rows = [(1, "http://a/é?x=%20", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"), (5, "v", "é" * 9000), (5, "v", "é" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_folder(spark, "test-warc")
    warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder)
    names = ("page_id", "record_type", "refers_to", "payload_bytes")
    found = sorted((tuple(r[n] for n in names) for r in got.collect()), key=str)
    assert found == sorted(
        [(1, "revisit", 2, 4), (2, "response", None, 4), (3, "revisit", 4, 0), (4, "response", None, 0), (None, "revisit", 2, 4), (5, "response", None, 18000), (5, "response", None, 18000)],
        key=str,
    )
    assert {r["page_id"]: r["url"] for r in got.collect()}[1] == "http://a/é?x=%20"
    assert got.where("record_type = 'revisit'").count() == 3 and got.where("page_id = 5").first()["payload"].decode() == "é" * 9000
    assert warc.read_archives(spark, folder, payload="false").where("payload is not null").count() == 0
    empty = new_folder(spark, "test-warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def foreign_records() -> list[bytes]:
    """Records as other programs write them: names in any case, ids of their own, blocks without HTTP."""
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    blocks = [
        ("warcinfo", "application/warc-fields", b"software: x\r\n"), ("response", "application/http; msgtype=response", http + b"<p>one</p>\r\n\r\nrest"),
        ("request", "application/http; msgtype=request", b"GET / HTTP/1.1\r\n\r\n"), ("resource", "text/plain", "é".encode() * 90_000),
        ("response", "application/http; msgtype=response", http),
    ]
    return [
        f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-Id: <urn:uuid:{i}-ab>\r\nWARC-Target-URI:http://a/{i}\r\ncontent-type: {media}\r\nContent-LENGTH: {len(block)}\r\n\r\n".encode()
        + block + b"\r\n\r\n"
        for i, (kind, media, block) in enumerate(blocks)
    ]


@pytest.mark.parametrize("kind", ["members", "one member", "plain", "after its own"])
def test_foreign_archives(spark, kind):
    records, folder = foreign_records(), new_folder(spark, "test-warc")
    own = [warc.member(warc.record(9, "u", b"mine", warc.digest(b"mine"), None))] if kind == "after its own" else []
    parts = {"plain": records, "one member": [gzip.compress(b"".join(records))]}.get(kind) or [*own, *map(gzip.compress, records)]
    warc.write_whole(f"{folder}/a.warc" + ".gz" * (kind != "plain"), parts)
    got = {r["record_id"]: r for r in warc.read_archives(spark, folder).collect()}
    sizes = {f"<urn:uuid:{i}-ab>": n for i, n in enumerate([13, 18, 0, 180_000, 0])}
    assert {i: r["payload_bytes"] for i, r in got.items()} == sizes | ({"<urn:page:9>": 4} if own else {})
    assert got["<urn:uuid:1-ab>"]["payload"] == b"<p>one</p>\r\n\r\nrest" and got["<urn:uuid:1-ab>"]["url"] == "http://a/1"
    assert got["<urn:uuid:3-ab>"]["payload_digest"] == warc.digest("é".encode() * 90_000) and got["<urn:uuid:2-ab>"]["payload"] is None
    some = warc.read_archives(spark, folder, where={"record_type": ["response", "warcinfo"], "payload_bytes": [18, 13]})
    assert sorted(r["record_id"][10] for r in some.collect()) == ["0", "1"]
    assert warc.read_archives(spark, folder, payload="false").where("payload is null").count() == len(got)


def test_broken_archives(spark):
    mine = warc.member(warc.record(9, "u", b"mine" * 999, warc.digest(b"mine" * 999), None))
    for parts, name in (([mine[:-20]], "a.warc.gz"), ([gzip.compress(foreign_records()[3][:-99])], "a.warc.gz"), ([b"no record\r\n\r\n"], "a.warc"), ([mine[:16] + bytes(4) + mine[20:]], "a.warc.gz")):
        folder = new_folder(spark, "test-warc")
        warc.write_whole(f"{folder}/{name}", parts)
        with pytest.raises(ValueError):
            list(warc.WarcReader({"path": folder}).read(warc.Part([f"{folder}/{name}"])))


def test_filters_on_one_frame_of_archives(spark):
    folder = new_folder(spark, "test-warc")
    warc.write_archives(spark.range(50).selectExpr("id as page_id", "'u' as url", "cast(id % 5 as string) as html"), folder)
    got = warc.read_archives(spark, folder)
    assert got.where("page_id = 3").unionAll(got.where("page_id = 48")).count() == 2 and got.count() == 50
    assert warc.read_archives(spark, folder, where={"record_type": ["response"]}).count() == 5
    assert warc.read_archives(spark, folder, pushdown=True).where("page_id in (3, 48) and record_type = 'response'").count() == 1
    reader = warc.PushedWarcReader({"path": folder})
    assert list(reader.pushFilters([warc.EqualTo(("page_id",), 3)])) == [] and reader.tests == [("page_id", (3,))]


def test_urls(spark):
    link = '<a href="{}">x</a>'
    rows = [
        (1, "http://Good.ORG/a?b", link.format("http://friend.net/x")), (2, "https://x.example.org/es/1#a", link.format("//other.net/")),
        (3, "https://example.org/en/17", None), (4, "http://shop.com/de/1", ""), (5, "http://friend.net", link.format("/own")),
        (6, "http://spam.net/1", link.format("http://shop.com/de/")), (7, None, None), (8, "no scheme", None), (9, "a://b://c/d", None), (9, "ftp://forg/x", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["page_id"], r["host"]): (r["path"], r["rule"], r["verdict"]) for r in url_graph.judge_urls(pages).collect()}
    assert got == {
        (1, "good.org"): ("/a", "org/", "allow"), (2, "x.example.org"): ("/es/1", "example.org/es/", "block"),
        (3, "example.org"): ("/en/17", "example.org/en/1", "block"), (4, "shop.com"): ("/de/1", "com/de/", "block"),
        (5, "friend.net"): ("", None, "allow"), (6, "spam.net"): ("/1", None, "block"), (7, ""): ("", None, "allow"), (8, ""): ("", None, "allow"),
        (9, "b:"): ("//c/d", None, "allow"), (9, "forg"): ("/x", None, "allow"),
    }
    assert url_graph.judge_urls(pages.limit(0)).count() == 0


def test_rank_agrees_with_plain_iteration(spark):
    edges = [("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 1.0), ("c", "d", 1.0)]
    got = url_graph.spread(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([("a", 2.0)], "host string, mass double"))
    score = {h: float(h == "a") for h in "abcd"}
    out = {"a": 1.0, "b": 2.0, "c": 2.0}
    for _ in range(400):  # until nothing changes any more
        sent = {h: sum(score[s] * w / out[s] for s, d, w in edges if d == h) for h in score}
        back = 0.15 + 0.85 * (1 - sum(sent.values()))
        score = {h: 0.85 * sent[h] + back * (h == "a") for h in score}
    assert {r["host"]: r["score"] for r in got.collect()} == pytest.approx(score, abs=1e-5)


def test_distrust_reaches_far_hosts(spark, monkeypatch):
    """A chain of thirty hosts that ends at a blocked one."""
    link = '<a href="http://h{}.net/">x</a>'
    pages = [(i, f"http://h{i}.net/", link.format(i + 1)) for i in range(29)]
    pages += [(29, "http://h29.net/", '<a href="http://shop.com/de/">x</a>'), (30, "http://shop.com/de/1", None), (31, "http://calm.net/", None)]
    got = url_graph.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {**dict.fromkeys(range(31), "block"), 31: "allow"}
    monkeypatch.setattr(url_graph, "MOST_STEPS", 3)
    with pytest.raises(RuntimeError, match="within 3 steps"):
        url_graph.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"))
