"""Each operator against brute force on small tables with nulls, empty, long and repeated rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, decontaminate, langid, licenses, line_dedup, mixing, pii, token_counts, warc
from tidemark.llm.queries import catalog

LONG = "word " * 20000
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "Ünï ☃"), (5, "Ünï ☃"), (None, "a b c")]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- decontamination ---

def brute_hits(text, items, window=13):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w, hit, found = re.findall(word, lower(text)), set(), set()
    for i, t in items:
        v = re.findall(word, lower(t))
        m = min(len(v), window)
        if v and i is not None:
            windows = {tuple(v[p:p + m]) for p in range(len(v) - m + 1)}
            for p in range(len(w) - m + 1):
                if tuple(w[p:p + m]) in windows:
                    hit |= set(range(p, p + m))
                    found.add(str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_words, pass_blocks", [(1_000_000, 4), (12, 3), (12, 100)])
def test_decontamination(spark, docs_of, block_words, pass_blocks):
    r = random.Random(1)
    vocabulary = ["a", "b", "É1", "d2"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 9])))) for i in range(12)]
    items += [(90, None), (91, "..."), (None, "a b"), (3, items[3][1])]
    rows = [(i, " ".join(r.choice(vocabulary + ["x", "y"]) for _ in range(r.randint(0, 60)))) for i in range(60)] + ODD
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    items = [x for x in items if x[0] is not None and len((x[1] or "").split()) > 1 or x[0] in (90, 91)]
    benchmark = benchmark.where("text like '% %' or text is null or text = '...'")
    got = decontaminate.match_benchmark(docs_of(rows), benchmark, 4, block_words, pass_blocks).collect()
    seen = sorted((x.doc_id or -1, x.n_words, sum(s.end - s.start for s in x.spans), list(x.item_ids)) for x in got)
    assert seen == sorted((i or -1, *brute_hits(t, items, 4)) for i, t in rows)


def test_no_benchmark(spark, docs_of):
    none = spark.createDataFrame([(1, None), (None, "a b"), (2, "...")], "item_id long, text string")
    for benchmark in (none, none.where("false")):
        got = decontaminate.match_benchmark(docs_of([(1, "a b c"), (2, None)]), benchmark).collect()
        assert sorted((x.doc_id, x.n_words, len(x.spans), len(x.item_ids)) for x in got) == [(1, 3, 0, 0), (2, 0, 0, 0)]


def test_automata_are_small():
    """Built and held within what the module states, for a block of unlike words and one of repeated ones."""
    r = random.Random(8)
    for vocabulary in (5, 10_000):
        items = [(str(i), " ".join(f"w{r.randrange(vocabulary)}" for _ in range(40))) for i in range(500)]
        assert len(decontaminate.build_block(items, 13)) < 110 * 40 * 500


def test_decontaminated_texts(spark, docs_of):
    item = "one two three four five"
    rows = [(1, "clean text here"), (2, item), (3, "é " * 200 + "One, two three-four; five END"), (4, None)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {x.doc_id: x.text for x in decontaminate.decontaminate(docs_of(rows), benchmark, 5).collect()}
    assert got == {1: "clean text here", 3: "é " * 200 + " END", 4: None}


def test_rows_that_share_an_id_are_judged_alone(spark, docs_of):
    item = "one two three four five"
    long = "é " * 200 + item + " end"
    rows = [(1, "clean text here"), (1, item), (1, long), (1, long), (None, "clean too"), (None, item), (None, long), (2, "clean text here")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = sorted(((x.doc_id or -1, x.text) for x in decontaminate.decontaminate(docs_of(rows), benchmark, 5).collect()))
    cut = "é " * 200 + " end"
    assert got == sorted([(1, "clean text here"), (1, cut), (1, cut), (-1, "clean too"), (-1, cut), (2, "clean text here")])


# --- personal data ---

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(v - 9 if v > 9 else v for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) \
                    or kind == "card" and 12 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans(docs_of):
    r = random.Random(2)
    parts = ["a@b.c", "x_a@b.c_d@e.f", "1.2.3.4", "256.1.1.1.7.8.9", "4111 1111-1111 1111", "4111111111111111", "0000 0000 0000 0",
             "+1 (555) 123-4567", "+12", "@", ".", "é", " ", "7", "-", "😀", "a", "00255.1.1.1", "\n", "12  34"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(1, 14)))) for i in range(300)] + ODD
    rows += [(900, "9" * 50000), (901, "a" * 50000 + "@"), (902, "+1" + " " * 50000), (903, "1." * 30000)]
    got = sorted(((x.doc_id or -1, [tuple(s) for s in x.base]) for x in pii.find_personal_data(docs_of(rows)).collect()), key=str)
    assert got == sorted(((i or -1, base_spans(t)) for i, t in rows), key=str)


def test_counts_of_each_kind(spark, docs_of, tmp_shared):
    """The query's counts and digest on texts with several spans of several kinds, in every order."""
    r = random.Random(9)
    parts = ["a@b.c ", "1.2.3.4 x ", "4111 1111-1111 1111, ", "+1 (555) 123-4567; ", "x_a@b.c ", "00255.1.1.1 y ", "none "]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(1, 8)))) for i in range(200)] + ODD
    docs_of(rows).write.parquet(f"{tmp_shared}/documents.parquet")
    names = list(PLAIN)

    def expected(i, text):
        spans = base_spans(text)
        digest = hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
        return (i, *(sum(s[1] == k for s in spans) for k in range(4)), digest)

    got = catalog()[0]["op3_personal_data"](spark, tmp_shared)
    got = [tuple(x) for x in got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()]
    assert sorted(got, key=str) == sorted((expected(*row) for row in rows), key=str)


def test_contexts_discover_identifiers(docs_of):
    rows = [(i, f"write to reach me: user{i}@mail.org now") for i in range(8)]
    rows += [(50, "write to reach me: hidden99887@localhost now"), (51, "some number 123456789 elsewhere")]
    got = {x.doc_id: (len(x.base), pii_text(dict(rows)[x.doc_id], x.spans)) for x in pii.find_personal_data(docs_of(rows)).collect()}
    assert got[50] == (0, ["hidden99887@localhost"]) and got[51] == (0, []) and got[3] == (1, ["user3@mail.org"])


def test_identifiers_beside_base_spans(docs_of):
    """A base span is no part of the instance beside it, whichever comes first."""
    rows = [(i, f"write to reach me: user{i}@mail.org now") for i in range(8)]
    rows += [(i, f"pay by card or call: user{i}@mail.org agent{i}0000@intern") for i in range(20, 28)]
    rows += [(i, f"and cc: {i}@a.org user{i}@mail.org") for i in range(30, 38)]
    rows += [(50, "and cc: joe1@mail.org hidden99887@localhost"), (51, "joe1@mail.org 5551234567 elsewhere")]
    got = {x.doc_id: (len(x.base), pii_text(dict(rows)[x.doc_id], x.spans)) for x in pii.find_personal_data(docs_of(rows)).collect()}
    assert got[50] == (1, ["joe1@mail.org", "hidden99887@localhost"])
    assert got[51] == (1, ["joe1@mail.org"])


def brute_added(rows):
    """The bootstrap in plain Python; one list of (start, kind, end) per row."""
    candidate = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*(?: [^\s0-9@]*[0-9]\S*)*")
    found, graph = [], {}
    for text in rows:
        text, at, out = text or "", 0, []
        base = base_spans(text)
        for m in candidate.finditer(text):
            before = text[at:m.start()][-64:]
            at, pieces, pos = m.end(), [], m.start()
            over = [(max(s, m.start()), k, min(e, m.end())) for s, k, e in base if s < m.end() and e > m.start()]
            for s, k, e in over:
                pieces += [(pos, max(pos, s), None), (max(pos, s), max(pos, e), k)]
                pos = max(pos, e)
            for s, e, k in [*pieces, (pos, m.end(), None)]:
                context = (before + text[m.start():s])[-64:]
                if k is None:
                    while s < e and text[s] in " \t\n\r\f\v\"'<[{(,;":
                        s += 1
                    while s < e and text[e - 1] in " \t\n\r\f\v.,;:!?\"')>]}":
                        e -= 1
                if s >= e:
                    continue
                words = ["<id>" if re.search("[0-9@]", w) else w for w in context.lower().split()]
                shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "0", text[s:e]))
                patterns = ([f"words {words[-2]} {words[-1]}"] if len(words) > 1 else []) + ([f"shape {words[-1]} {shape}"] if words else [])
                out.append((s, e, k, patterns))
                for p in patterns:
                    graph.setdefault(p, {}).setdefault(text[s:e], set()).update([] if k is None else [k])
        found.append((text, out))
    seeds = {(t, k): 1.0 for tokens in graph.values() for t, kinds in tokens.items() for k in kinds}
    known, size = dict(seeds), 0
    while True:
        accepted = {}
        for p, tokens in graph.items():
            for k in range(4):
                scores = [known[t, k] for t in tokens if (t, k) in known]
                if len(scores) >= 3 and sum(scores) / len(tokens) >= 0.75:
                    accepted[p, k] = sum(scores) / len(tokens)
        if len(accepted) == size:
            break
        size, known = len(accepted), dict(seeds)
        for (p, k), c in accepted.items():
            for t in graph[p]:
                known[t, k] = max(known.get((t, k), 0), c)
    added = []
    for text, out in found:
        spans = []
        for s, e, k, patterns in out:
            if k is None and ("@" in text[s:e] or len(re.sub("[^0-9]", "", text[s:e])) >= 5):
                best = sorted((-c, kind) for (p, kind), c in accepted.items() if p in patterns)
                spans += [(s, best[0][1], e)] if best else []
        added.append(spans)
    return added


def test_bootstrap_by_brute_force(docs_of):
    r = random.Random(21)
    contexts = ["reach me:", "call us on", "host at", "paid with card", "and also", "or"]
    things = [lambda: f"user{r.randint(1, 200)}@mail.org", lambda: f"agent{r.randint(10000, 10003)}@intern", lambda: f"+1 555 {r.randint(1000000, 1000200)}",
              lambda: f"0{r.randint(555000, 555003)}9", lambda: f"10.0.0.{r.randint(1, 200)}", lambda: "4111 1111 1111 1111",
              lambda: f"10.0.0.{r.randint(300, 303)}", lambda: "99", lambda: "word"]
    likely = [[0, 0, 0, 1], [2, 2, 2, 3], [4, 4, 4, 6], [5, 3], [0, 1, 2, 8], [7, 8, 0]]
    rows = []
    for i in range(400):
        parts = []
        for _ in range(r.randint(1, 4)):
            c = r.randrange(len(contexts))
            parts += [contexts[c], *(things[r.choice(likely[c])]() for _ in range(r.choice([1, 1, 1, 2, 3])))]
        rows.append((i, r.choice([" ", ", "]).join(parts)))
    rows += [(900, None), (901, ""), (902, "9" * 3000)]
    want = {i: spans for (i, _), spans in zip(rows, brute_added([t for _, t in rows]))}
    got = {x.doc_id: sorted({tuple(s) for s in x.spans} - {tuple(s) for s in x.base}) for x in pii.find_personal_data(docs_of(rows)).collect()}
    assert got == {i: sorted(s) for i, s in want.items()}
    assert sum(map(bool, want.values())) > 20


def pii_text(text, spans):
    return [text[s.start:s.end] for s in spans]


# --- language ---

def test_language(spark, docs_of):
    r = random.Random(4)
    words = {"en": ["the", "and", "of", "with"], "de": ["der", "und", "für", "ist"]}
    rows = [(i, " ".join(r.choice(words[x]) for _ in range(30)), x) for i in range(80) for x in words]
    learn = spark.createDataFrame([(2 * i + (x == "de"), t, x) for i, t, x in rows] + [(999, "la", None), (998, None, "en")],
                                  "doc_id long, text string, lang string")
    model = langid.train(learn, per_language=50)
    assert model.languages == ["de", "en"]
    got = {(x.doc_id, x.lang_pred): x.score for x in langid.identify(
        docs_of([(1, "the end of the day"), (2, "UND DER TAG"), (6, "123 !"), (7, None), (8, LONG), (8, LONG)]), model).collect()}
    assert set(got) >= {(1, "en"), (2, "de"), (6, "und"), (7, "und")} and got[6, "und"] == 0 and got[1, "en"] > 0.5
    alone, together = model.predict(["the day"])[1], model.predict(["x", "the day", "y"])[1]
    assert alone[0] == together[1]
    empty = langid.train(learn.where("false"))
    assert empty.predict(["abc"])[0] == ["und"]
    kept = langid.keep_identified(docs_of([(1, "the and"), (2, "...")]), model, 0.3)
    assert [x.doc_id for x in kept.collect()] == [1]


# --- licenses ---

def test_licenses(docs_of):
    rows = [(10, "Under the MIT License. under-the mit, license"), (11, "Licensed under the Apache License, Version 2.0."),
            (12, "gnu general public license as published by the free software foundation, either version 3"),
            (13, "gnu general public license as published by version 3"), (14, "Copyright (c) 2020 Some One. All rights reserved."),
            (15, "cc by nc cc by nc")] + ODD
    got = {x.doc_id: [(m.first, m.end, m.label, m.base) for m in x.matches] for x in licenses.scan_licenses(docs_of(rows)).collect()}
    assert got[10] == [(0, 4, "mit", True), (4, 8, "mit", True)]
    assert got[11] == [(3, 7, "apache-2", True)]
    assert [m[2] for m in got[12]] == ["gpl-3"] and got[13] == [] and [m[2] for m in got[14]] == ["all-rights-reserved"]
    assert [m[:2] for m in got[15]] == [(0, 3), (3, 6)] and got[1] == got[2] == got[4] == []


def template_regex(markup):
    """A template as an expression over words that each end in a blank."""
    out = []
    for token in markup.replace("[[", " [[ ").replace("]]", " ]] ").split():
        if token == "[[":
            out.append("(?:")
        elif token == "]]":
            out.append(")?")
        elif token.startswith("{{"):
            out.append(r"(?:\S+ ){0,%s}" % token[2:-2])
        else:
            out.append("(?:" + "|".join(re.escape(w) for w in token.split("|")) + ") ")
    return re.compile("".join(out))


def filled(r, markup):
    """A text that a template accepts: optional regions kept or not, replaceable ones filled."""
    text = markup
    while "[[" in text:
        text = re.sub(r"\[\[([^\[\]]*)\]\]", lambda m: m[1] if r.random() < 0.5 else " ", text)
    words = []
    for token in text.split():
        if token.startswith("{{"):
            words += [r.choice(["the", "ACME", "authors", "Ünï"]) for _ in range(r.randint(0, int(token[2:-2])))]
        else:
            words.append(r.choice(token.split("|")))
    return words


def test_licenses_by_brute_force(docs_of):
    r = random.Random(12)
    expressions = [template_regex(t.markup) for t in licenses.TEMPLATES]
    rows = []
    for i in range(90):
        t = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        words = ["x"] * r.randint(0, 3) + filled(r, t.markup) + ["y"]
        if i % 3 == 2:  # one word changed, left out or added
            at = r.randrange(len(words))
            words[at:at + 1] = r.choice([[], ["other"], [words[at], "more"]])
        rows.append((i, r.choice([" ", ", ", "\n"]).join(w.upper() if r.random() < 0.2 else w for w in words)))
    got = {x.doc_id: [(m.first, m.end, m.label, m.whole) for m in x.matches] for x in licenses.scan_licenses(docs_of(rows)).collect()}
    n_whole = 0
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        want = []
        for t, expression in zip(licenses.TEMPLATES, expressions):
            for at in range(len(words)):
                joined = "".join(w + " " for w in words[at:])
                if expression.match(joined):
                    end = next(e for e in range(at + 1, len(words) + 1) if expression.fullmatch("".join(w + " " for w in words[at:e])))
                    want.append((at, end, t.label, t.whole))
        assert sorted(got[i]) == sorted(want), text
        n_whole += any(w[3] for w in want)
    assert n_whole > 20


def test_covered_words_count_once(spark):
    schema = "m array<struct<first:int,end:int>>"
    rows = [([(0, 4), (2, 6), (3, 5), (8, 9)],), ([],), ([(5, 7), (7, 8)],)]
    assert [x[0] for x in spark.createDataFrame(rows, schema).select(licenses.covered_words(F.col("m"))).collect()] == [7, 0, 3]


# --- archives ---

@pytest.mark.parametrize("fan_in, ranges, block", [(2, 3, 2), (64, None, 2000)])
def test_archives(spark, fan_in, ranges, block):
    long = "x" * 200
    rows = [(5, "http://b.org/1", long), (3, "http://www.B.org/1#f", long), (9, None, long), (4, "http://a.org/", "short"),
            (8, "http://a.org/", "short"), (1, "http://[bad", None), (2, "https://a.org/z?q=é", "é" * 60), (7, "http://a.org/", "é" * 60),
            (None, "http://a.org/", long), (6, "", "")]
    pages = spark.createDataFrame([(*x, "clash") for x in rows], "page_id long, url string, html string, digest string").repartition(7)
    got = warc.capture_history(pages, fan_in=fan_in, ranges=ranges, block_lines=block).orderBy("range", "place").collect()
    keys = [(x.url_key, x.captured, x.page_id is None, x.page_id or 0) for x in got]
    assert len(got) == len(rows) and keys == sorted(keys)
    first = {}
    for i, _, h in sorted((x for x in rows if x[0] is not None)):
        first.setdefault(h or "", i)
    for x in got:
        h = next(h or "" for i, _, h in rows if i == x.page_id)
        raw = h.encode()
        other = first.get(h) if x.page_id is not None and len(raw) >= 100 else x.page_id
        assert (x.payload_bytes, x.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (x.record_type, x.refers_to) == (("response", None) if other == x.page_id else ("revisit", other))
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.capture_history(none).collect() == []


def test_archives_of_one_payload(spark):
    """One payload on most pages, pages that repeat whole or with another payload."""
    html = "<p>" + "not found " * 20
    rows = [(i, f"http://x.org/{i}", html) for i in range(400)] + [(7, "http://x.org/7", html)] * 3 + [(7, "http://x.org/7", "é" * 200)]
    rows += [(500, "http://y.org", "é" * 200), (None, "http://z.org", html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [(x.page_id, x.record_type, x.refers_to) for x in warc.capture_history(pages, fan_in=4).collect()]
    want = [(i, "response" if i in (0, None) or h != html and i == 7 else "revisit",
             None if i in (0, None) or h != html and i == 7 else 0 if h == html else 7) for i, _, h in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_loser_tree_merges():
    r = random.Random(6)
    for k in range(1, 9):
        runs = [sorted([[str(r.randint(0, 9)), "", [False, r.randint(0, 99)]] for _ in range(r.randint(0, 7))]) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in runs])) == sorted(e for x in runs for e in x)


# --- mixing ---

def test_mixing(spark):
    r = random.Random(7)
    rows = [(i, " ".join(["w"] * r.randint(0, 30)), r.choice(["a", "b", "c", None])) for i in range(400)]
    rows += [(900, LONG, "a"), (901, None, "d"), (None, "x y", "b"), (3, rows[3][1], rows[3][2])]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    total = {}
    for x in got:
        assert x.taken <= 2 * x.size
        t = total.setdefault(x.source, [x.target, x.source_size, 0])
        t[2] += x.taken
    assert abs(sum(t[0] for t in total.values()) - 1.5 * sum(t[1] for t in total.values())) < 1e-6
    for source, (target, size, taken) in total.items():
        assert target <= 2 * size and abs(taken - target) <= max([len((t or "").split()) for _, t, s in rows if s == source])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(docs.where("false")).collect() == []


# --- token counts ---

def greedy(pieces, word, end):
    text, n, at = word + end, 0, 0
    while at < len(text):
        k = next((k for k in range(len(text), at, -1) if text[at:k] in pieces), None)
        if k is None:
            return n + max(len(word) - at, 1)
        n, at = n + 1, k
    return n


def test_token_counts(docs_of):
    r = random.Random(8)
    for end in ("", "</w>"):
        pieces = {"".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(25)} - {"c"}
        pieces |= {p + end for p in list(pieces)[:10]}
        automaton = token_counts.LongestMatch(sorted(pieces), end)
        for _ in range(3000):
            word = "".join(r.choice("abcd") for _ in range(r.randint(1, 12)))
            assert automaton.count(word) == greedy(pieces, word, end), word
    got = {x.doc_id: (x.n_words, x.n_tokens) for x in token_counts.count_tokens(
        docs_of([*ODD, (20, "ab AB abab"), (21, "a" * 40000)]), ["a", "b", "ab"]).collect()}
    assert got[20] == (3, 4) and got[1] == got[2] == got[3] == (0, 0) and got[21] == (1, 40000)


# --- lines ---

def one_edit(a, b):
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a == b or a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def test_line_dedup(docs_of):
    r = random.Random(9)
    lines = ["".join(r.choice("ab é") for _ in range(r.choice([3, 16, 17, 40]))) for _ in range(30)] + ["", "  ", "x" * 300]
    for x in list(lines):
        for _ in range(3):
            at = r.randrange(len(x) + 1)
            lines.append(r.choice([x[:at] + "Z" + x[at:], x[:at] + x[at + 1:], x[:at] + "q" + x[at + 1:], " " + x.upper()]))
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 6)))) for i in range(60)] + ODD
    got = sorted(((x.doc_id or -1, x.text) for x in line_dedup.dedup_lines(docs_of(rows)).collect()), key=str)
    norm = lambda x: x.strip(" \t\x0b\x0c\r").lower()
    first = {}
    for i, t in rows:
        for p, x in enumerate((t or "").split("\n") if i is not None else []):
            first[norm(x)] = min(first.get(norm(x), (i, p)), (i, p))
    gone = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= 16 and one_edit(a, b)}
    want = [(i or -1, t if i is None or t is None else "\n".join(
        x for p, x in enumerate(t.split("\n")) if not norm(x) or norm(x) not in gone and first[norm(x)] == (i, p))) for i, t in rows]
    assert got == sorted(want, key=str)
    assert len(gone) > 10 and line_dedup.dedup_lines(docs_of([])).collect() == []


# --- neighbours ---

def exact(x, ids, q, own, k):
    d = np.sqrt(((x - q) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != own][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_VECTORS", 100)
    r = np.random.default_rng(3)
    x = (r.standard_normal((40, 32))[r.integers(0, 40, 3000)] + 0.7 * r.standard_normal((3000, 32))).astype(np.float32)
    x[500:1400] = x[500]  # one very common vector
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for row in ann.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0")).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    y, ids, same, ties = x.astype(float), np.arange(3000), 0, 0
    for q in range(0, 3000, 100):
        want = exact(y, ids, y[q], q, 10)
        have = [(v, s) for _, v, s in sorted(got[q])]
        assert [k for k, *_ in sorted(got[q])] == list(range(1, 11))
        same += len({v for v, _ in want} & {v for v, _ in have})
        if 500 <= q < 1400:
            ties += [v for v, _ in have] == [v for v, _ in want]
    assert same / 300 >= 0.9 and ties == 9


@pytest.mark.parametrize("n", [1023, 1024, 2000, 5000])
def test_neighbours_recall_without_clusters(spark, n):
    x = np.random.default_rng(n).standard_normal((n, 64))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for row in ann.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0")).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    asked = range(0, n, 100)
    same = sum(len(got[q] & {v for v, _ in exact(x, np.arange(n), x[q], q, 10)}) for q in asked)
    assert same / (10 * len(asked)) >= 0.95


def test_further_lists_are_left_out_only_if_they_hold_nothing_nearer():
    r = np.random.default_rng(5)
    x = r.standard_normal((60, 48))[r.integers(0, 60, 6000)] + 0.25 * r.standard_normal((6000, 48))
    centres = ann._fit(x[:2000], 60)
    at = ann._nearest(x, centres)
    sizes = np.bincount(at, minlength=60)
    radii = np.array([ann._apart(x[at == c], centres[c]).max(initial=0) for c in range(60)])
    near = ann.probe_lists(x[:200], None, centres, sizes, radii, 10, 1.0)
    held = [np.sort(ann._apart(x[np.isin(at, c)], x[i])) for i, c in enumerate(near)]
    assert all(len(h) >= 500 for h in held)
    within = np.array([h[10] for h in held])  # h[0] is the query itself
    far = ann.probe_lists(x[:200], within, centres, sizes, radii, 10, 1.0)
    read = 0
    for i in range(200):
        best = np.argsort(ann._apart(x, x[i]))[:11]
        assert set(at[best]) <= {*near[i], *far[i]} and not {*near[i]} & {*far[i]}
        read += sizes[[*near[i], *far[i]]].sum()
    assert read < 0.5 * 200 * len(x)


def test_neighbours_recall_of_the_embeddings(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])
    at = {int(i): p for p, i in enumerate(ids)}
    got = {}
    for row in ann.nearest_neighbours(vectors, vectors).collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    asked = sorted(got)[::7]
    same = sum(len(got[q] & {v for v, _ in exact(x, ids, x[at[q]], q, 10)}) for q in asked)
    assert len(got) == len(ids) and same / (10 * len(asked)) >= 0.95


def test_neighbours_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [1.0]),
            (7, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 1.0]), (100, [float("inf"), 0.0])]
    vectors = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, list int")
    got = [(x.query_id, x["rank"], x.vec_id, x.score) for x in
           ann.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 0.0), (0, 2, 8, 0.0), (0, 3, 1, 2 ** 0.5)]
    assert ann.nearest_neighbours(vectors.where("false"), vectors).collect() == []
