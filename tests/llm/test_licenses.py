"""License scan of long, altered and short templates, against windows read one by one."""

import random
import re

import pytest

from telemetra.llm import licenses
from telemetra.llm.license_texts import NOTICES, TEXTS

FILLER = [f"word{i}" for i in range(500)]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_loop(docs, templates):
    """(document, license): windows at 0.8 of a template or more, the best share, the first shared place."""
    found = {}
    for name, text in {(n, t) for n, t in templates if n is not None and words_of(t)}:
        words = words_of(text)
        width = min(len(words), 5)
        grams = lambda w: [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]
        wanted = set(grams(words))
        scale = 1 << (len(wanted) - 1).bit_length()
        for i, doc in docs:
            shingles = grams(words_of(doc))
            for start in range(0, max(len(shingles), 1), scale):
                held = shingles[start : start + 2 * scale]
                share = len(wanted & set(held)) / len(wanted)
                if share >= 0.8:
                    n, best, first = found.get((i, name), (0, 0.0, 1 << 60))
                    place = start + min(k for k, g in enumerate(held) if g in wanted)
                    found[i, name] = n + 1, max(best, share), min(first, place)
    return found


def scanned(spark, docs, templates):
    rows = licenses.scan(spark.createDataFrame([(*d, "x") for d in docs], "doc_id LONG, text STRING, license_id STRING"), spark.createDataFrame(templates, "license_id STRING, text STRING")).collect()
    return {(r["doc_id"], r["license_id"]): (r["n_windows"], r["containment"], r["position"]) for r in rows}


def altered(rng, text, share):
    words = text.split()
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = rng.choice(FILLER)
    return " ".join(words)


def test_altered_whole_texts_anywhere(spark):
    """Whole licenses with some words changed, at every place relative to the windows' borders, among other text."""
    rng, docs = random.Random(1), []
    for k, (name, text) in enumerate(sorted(TEXTS.items()) * 6):
        before = [rng.choice(FILLER) for _ in range(rng.randrange(700))]
        after = [rng.choice(FILLER) for _ in range(rng.randrange(300))]
        docs.append((k, " ".join([*before, altered(rng, text, rng.choice([0, 0, 0.01, 0.02, 0.05, 0.15])), *after])))
    templates = sorted({**NOTICES, **TEXTS}.items())
    expected = by_loop(docs, templates)
    found = scanned(spark, docs, templates)
    assert found == expected
    changed = [v[1] for v in expected.values() if v[1] < 1]
    assert len(changed) > 8 and min(changed) < 0.92  # altered ones are among those found
    assert len({i for i, _ in expected}) < len(docs)  # and those altered too much are not


def test_bands_retrieve_a_template_among_look_alikes(spark):
    """Templates that share most of their shingles with others: bands and verification tell them apart."""
    rng = random.Random(2)
    whole = [rng.choice(FILLER) for _ in range(2000)]
    templates = [(f"t{k}", " ".join(whole[k * 40 : k * 40 + 400])) for k in range(40)]
    docs = [(k, " ".join([*rng.choices(FILLER, k=k * 7), *whole[k * 40 : k * 40 + 400], *rng.choices(FILLER, k=50)])) for k in range(0, 40, 5)]
    assert scanned(spark, docs, templates) == by_loop(docs, templates)


def test_short_templates(spark):
    templates = [("spdx", "SPDX-License-Identifier: MIT"), ("one", "copyleft"), ("two", "public domain"), ("none", " ... "), (None, "copyleft"), ("null", None)]
    docs = [(1, "// SPDX-License-Identifier: MIT\ncode"), (2, "It is public; domain"), (3, "spdx license identifier isc"), (4, "Copyleft"), (5, None), (6, ""), (7, "copyleft"), (7, "copyleft copyleft")]
    found = scanned(spark, docs[:6], templates)
    assert {k: v[1:] for k, v in found.items()} == {(1, "spdx"): (1.0, 0), (2, "two"): (1.0, 2), (4, "one"): (1.0, 0)}
    assert found == by_loop(docs[:6], templates)
    assert set(scanned(spark, docs, templates)) == {*found, (7, "one")}


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_a_long_list_is_one_scan(spark, monkeypatch, bits):
    """Whatever the size of the filter, the same is found; the documents are read once."""
    monkeypatch.setattr(licenses, "MOST_BITS", bits)
    rng = random.Random(3)
    templates = [(f"t{k}", " ".join(rng.choice(FILLER) for _ in range(rng.randrange(3, 60)))) for k in range(300)]
    docs = [(k, " ".join([*rng.choices(FILLER, k=rng.randrange(40)), templates[k * 7][1], *rng.choices(FILLER, k=9)])) for k in range(30)]
    reads = []
    monkeypatch.setattr(licenses, "stage", lambda df, keep=licenses.stage: reads.append(df.columns) or keep(df))
    assert scanned(spark, docs, templates) == by_loop(docs, templates)
    assert sum("doc_id" in c for c in reads) == 1


def test_notices_table(spark):
    assert {tuple(r) for r in licenses.notices(spark).collect()} == {*NOTICES.items(), *TEXTS.items()}
