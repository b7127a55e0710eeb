import math
import re

from rescuelens.llm import license_scan as ls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def places(w, phrase):
    p = phrase.split(" ")
    return [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]


def brute(rows):
    """The whole scan in plain Python."""
    split = [words(t) for _, t in rows]
    index = set(ls.INDEX_WORDS)
    texts = {w: sum(w in s for s in split) for w in index}
    idf = {w: math.log1p(len(rows) / n) for w, n in texts.items() if n}
    out = []
    for (k, _), w in zip(rows, split):
        base = {label: places(w, phrase) for phrase, label in ls.BASE.items()}
        every = [p for found in base.values() for p in found]
        labels, best = {label for label, found in base.items() if found}, 0.0
        names = sorted(labels)
        rare = sorted({(idf[x], x) for x in w if x in idf}, reverse=True)[:ls.RAREST]
        rare = {x for _, x in rare}
        for label, phrase, text in ls.TEMPLATES:
            t = text.split(" ")
            whole = sum(idf.get(x, ls.UNSEEN) for x in t if x in index)
            shifts = {}
            for at, x in enumerate(w):
                if x in rare:
                    for place, y in enumerate(t):
                        if x == y:
                            shifts[at - place] = shifts.get(at - place, 0) + idf[x]
            for shift, found in shifts.items():
                start = shift + places(t, phrase)[0]
                if found / whole >= ls.LEAST_SHARE and start >= 0 and w[start:start + len(phrase.split())] == phrase.split():
                    labels.add(label)
                    best = max(best, min(1.0, found / whole))
        out.append((k, len(w), len(every), min(every, default=None), max(every, default=None), ",".join(names),
                    ",".join(sorted(labels)), round(1.0 if names else best, 9)))
    return sorted(out, key=str)


TEXTS = [text for _, _, text in ls.TEMPLATES]
ROWS = ([(k, "intro words here. " + t.replace(" ", ", ", 2) + " -- tail") for k, t in enumerate(TEXTS)]
        + [(50, None), (51, ""), (52, "Released under the MIT License. MIT-license; Apache\nLicense"),
           (53, "cc by cc by cc"), (54, "the license of the software is public"), (55, "GNU General Public Licence"),
           (56, "Licensed under CC BY-NC 4.0."), (57, "word " * 20_000 + "mit license"), (57, "mit license"),
           (58, "Permission is hereby granted to any person obtaining a copy of this software")]
        + [(100 + k, "plain text without any of it") for k in range(40)])


def test_against_brute_force(docs):
    out = ls.scan(docs(ROWS)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9))
           for r in out]
    assert sorted(got, key=str) == brute(ROWS)
    found = {r.doc_id: r.labels.split(",") for r in out}
    for k, (label, _, _) in enumerate(ls.TEMPLATES):
        assert label in found[k]


def test_empty_table(docs):
    assert ls.scan(docs([])).collect() == []


def test_no_candidates(docs):
    out = ls.scan(docs([(1, "nothing"), (2, None)])).collect()
    assert [(r.n_base, r.labels, r.score) for r in out] == [(0, "", 0.0)] * 2


def test_templates_hold_their_phrases():
    for _, phrase, text in ls.TEMPLATES:
        assert places(text.split(" "), phrase), phrase


def test_native_plan(docs):
    plan = ls.scan(docs(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_file_of_several_licences(docs):
    names = ["mit", "bsd", "apache", "mpl", "isc"]
    text = "\n\n".join(f"Notice {k}. {t}" for k, t in enumerate(t for label, _, t in ls.TEMPLATES if label in names))
    rows = [(1, text), (2, text + " " + " ".join(ls.INDEX_WORDS))] + [(100 + k, "plain text") for k in range(40)]
    out = {r.doc_id: r for r in ls.scan(docs(rows)).collect()}
    for k in (1, 2):
        assert out[k].labels == ",".join(sorted(names))
        assert sorted(h.label for h in out[k].hits) == sorted(names)
        assert all(h.share > 0.999 for h in out[k].hits)
