"""Chat formatting, quality rules, personal data, decontamination and URL filters, against plain Python."""

import hashlib
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from lodestone.llm import chat, decontam, pii, quality, url_graph

DOCS = "doc_id long, text string, lang string, kept boolean, words string, ids string"
GAP = re.compile(r"[\x20\x09-\x0D]+")


def docs_of(spark, rows):
    """Documents with columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, None, None, "x", None) for i, t in rows], DOCS)


def random_texts(n, seed=3):
    rng = random.Random(seed)
    alphabet = ["a", "bb", "c.", "#", "é", "\n", "\t", "  ", "x|y", "THE", "1.2.3.4", "a@b.co", "+1 (222) 333-4444"]
    return [" ".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 40, 200]))) for _ in range(n)]


EDGE = [None, "", " \n\t", "one", "w " * 3000, "é" * 5000, "a b c d e f g h " * 2, "x\ny\nx\n \nx"]


# --- quality ---------------------------------------------------------------------------------------


def base_rules(text):
    words = [w for w in GAP.split(text or "") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    places = {}
    for i, w in enumerate(windows):
        places.setdefault(w, []).append(i)
    repeated = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if GAP.sub("", x)]
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_quality_base(spark):
    texts = EDGE + random_texts(60)
    rows = quality.quality_rules(docs_of(spark, [*enumerate(texts), (0, None)])).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base_rules(r.doc.text)
        assert not (r.kept and r.base_failed)


def test_quality_lines(spark):
    prose = "\n".join(f"This{i} is{i} line{i} of{i} ordinary{i} prose{i}, with{i} an{i} end{i}." for i in range(8))
    nav = "\n".join("Home | About | News | Contact | Help | More" + str(i) for i in range(8))
    rows = [(1, prose), (2, nav), (3, prose + "\nAll rights reserved."), (4, prose + "\n" + prose.split("\n")[0])]
    rows = [(5, nav + "\n" + prose[:60]), (None, prose), *rows]
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in quality.keep_good(docs).collect()}
    assert set(got) == {1, 3, 4, None} and quality.keep_good(docs).columns == docs.columns
    assert all(r.text == prose for r in got.values())


def test_keep_good_of_repeated_text(spark):
    """A long text of repeats is judged once: the filter holds none of the rules."""
    rng = random.Random(5)
    prose = "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) + "." for _ in range(50))
    docs = docs_of(spark, [(1, "one two three four five six seven eight, nine ten. " * 500), (2, prose), (3, None), (2, prose)])
    kept = quality.keep_good(docs)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, prose), (2, prose)]
    filters = [line for line in kept._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in line]
    assert len(filters) == 1 and "hash" not in filters[0]


def test_quality_empty_table(spark):
    assert quality.quality_rules(docs_of(spark, [])).count() == 0


# --- personal data ---------------------------------------------------------------------------------


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_pii_base(spark):
    rng = random.Random(5)
    parts = ["a", "@", ".", "b1", "1", "22", "256", "+", "-", " ", "(", ")", "é", "%", "4111 1111 1111 1111", "\n", "x@y.z"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += EDGE + ["a@b.c%d@e.f", "1.2.3.4.5.6.7.8", "1.1.1.1.1", "0001.2.3.255", "9" * 3000, "5555555555554444x", "😀 a@b.co 😀"]
    docs = docs_of(spark, [*enumerate(texts), (0, texts[0]), (None, "me@here.org")])
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(texts) + 2
    want = {i: base_pii(t) for i, t in enumerate(texts)} | {None: [(0, 0, 11)]}
    for r in rows:
        assert [tuple(x) for x in r.base] == want[r.doc_id]
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_pii_bootstrapping(spark):
    known = [(i, f"please phone: +1 (222) 333-44{i:02d} now") for i in range(10, 30)]
    rows = [*known, (100, "or phone: 555-2368-77 later"), (101, "nothing 555-2368-78 here"), (102, "5 apples")]
    docs = docs_of(spark, rows)
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find_pii(docs).collect()}
    assert got[100] == [(10, 3, 21)] and got[101] == [] and got[102] == []
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[100] == "or phone: <PHONE> later" and clean[10] == "please phone: <PHONE> now" and clean[102] == "5 apples"
    assert pii.redact(docs).columns == docs.columns


def test_pii_later_rounds(spark):
    """Numbers that a first context finds make a second one confident, and undecided ones don't count against it."""
    local = [f"555-23{n}-77" for n in range(10, 40)]
    rows = [(i, f"please phone: +1 (222) 333-44{i:02d} now") for i in range(10, 30)]
    rows += [(100 + x, f"or phone: {v} later") for x, v in enumerate(local)]
    rows += [(200 + x, f"just ring {v} soon") for x, v in enumerate(local)]
    rows += [(300, "just ring 777-1234-99 soon"), (301, "id 777-1234-98 here")]
    rows += [(400 + x, f"card: {v} end") for x, v in enumerate(["a@b.co", "c@d.org", "e@f.net", "g@h.com", "i@j.io"])]
    rows += [(500 + x, f"pay card: {v} now") for x, v in enumerate(["4111 1111 1111 1111", "5555 5555 5555 4444", "4012888888881881", "378282246310005", "6011111111111117", "4111-1111-1111-1112"])]
    docs = docs_of(spark, rows)
    found = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find_pii(docs).collect()}
    assert all(found[100 + x] == [(10, 3, 21)] for x in range(30))
    assert found[300] == [(10, 3, 21)] and found[301] == []
    assert found[504] == [(10, 2, 26)] and found[505] == []  # a number as long as a card that fails its check digit
    once = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find_pii(docs, rounds=1).collect()}
    assert once[100] == [(10, 3, 21)] and once[300] == []


def test_pii_secrets_and_contexts(spark):
    """Keys are seeds of a kind that contexts extend: one word before, two words before, or the word after."""
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(38)) + "a1"
    rows = [(i, f'set token = "{key()}" w{i}') for i in range(12)]
    rows += [(20, 'my token = "Zx81-qqTTrL09_ppQw" now'), (21, "the word Zx81-qqTTrL09_ppQw again"), (22, key())]
    rows += [(300 + i, f"x{i} key of {key()} end{i}") for i in range(12)] + [(400 + i, f"y{i} path of dir{i}-1234567890-abcdef z{i}") for i in range(12)]
    rows += [(60, "some key of AbCd1234efGh5678xy ok"), (70, "other of AbCd1234efGh5678xz ok")]
    rows += [(800 + i, f"q{i} {key()} is-secret") for i in range(12)] + [(90, "zz abcdefgh-12345678-ij is-secret")]
    docs = docs_of(spark, rows)
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find_pii(docs).collect()}
    assert got[0] == [(13, 4, 53)] and got[22] == [(0, 4, 40)]
    assert got[20] == [(12, 4, 30)] and got[21] == []
    assert got[60] == [(12, 4, 30)] and got[70] == [] and got[90] == [(3, 4, 23)] and got[400] == []


def test_redact_with_clashing_names(spark):
    rows = [(1, "mail a@b.co now", 5, "s", "k", "n"), (None, None, 0, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string, text_key string, _spans string")
    got = sorted(map(tuple, pii.redact(docs).collect()), key=str)
    assert got == [(1, "mail <EMAIL> now", 16, "s", "k", "n"), (None, None, None, None, None, None)]


def test_pii_empty_table(spark):
    assert pii.find_pii(docs_of(spark, [])).count() == 0


# --- decontamination -------------------------------------------------------------------------------


def test_decontaminate(spark):
    item = "A train leaves the station at 60 km with 12 cars and meets another train with 12 cars at noon sharp today"
    other = item.replace("60", "75").replace("12", "31")
    mixed = item.replace("12", "31", 1)
    filler = "lorem ipsum dolor sit amet consectetur elit sed do eiusmod. "
    rows = [(1, filler + item + " " + filler), (2, filler * 3), (3, filler + other), (4, mixed), (5, None), (6, ""), (None, item)]
    docs = docs_of(spark, [*rows, (1, "more text")])
    benchmark = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.decontaminate(docs, benchmark).collect()}
    assert set(got) == {(1, 7), (3, 7), (4, 7), (None, 7)}
    assert not got[4, 7].same_values and got[4, 7].n_windows < got[4, 7].item_windows
    assert got[1, 7].same_values and got[1, 7].n_windows == got[1, 7].item_windows and not got[3, 7].same_values
    left = decontam.drop_leaked(docs, benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [2, 5, 6] and left.columns == docs.columns


def template(text):
    """Template words and values, by the operator's patterns in another engine."""
    text = regex.sub(decontam.NAME, r" ‹name…\1›", text)
    text = regex.sub(decontam.NUMBER.replace(r"\x{20AC}\x{A3}", "€£"), r" ‹num…\1›", text)
    text = regex.sub(r"(?<=\p{Nd})[.,:/](?=\p{Nd}+(?:[.,:/]\p{Nd}+)*›)", "p", text)
    text = regex.sub(r"(?<=›)\x20?%", " ‹unit…percent› ", text)
    text = regex.sub(decontam.UNIT.replace(r"\x{203A}", "›"), r" ‹unit…\1› ", text)
    words = [w for w in regex.split(r"[^\p{L}\p{N}‹›…]+", text.lower()) if w]
    return [(w.split("…")[0], w) if w.startswith("‹") else (w, None) for w in words]


def brute_leaks(docs, benchmark):
    def windows(words, n):
        for i in range(len(words) - n + 1):
            part = words[i : i + n]
            slots = [v for _, v in part if v]
            if n - len(slots) >= 2:
                yield i, tuple(k for k, _ in part), slots

    for item_id, item in benchmark:
        words = template(item or "")
        n = min(len(words), 5)
        own = list(windows(words, n)) if n > 1 else []
        places, slots_met, same = {}, {}, {}
        for doc_id, text in docs:
            lines = {}
            for i, kinds, slots in windows(template(text or ""), n) if own else []:
                for j, item_kinds, item_slots in own:
                    if kinds == item_kinds:
                        lines.setdefault(i - j, []).append((j, list(zip(item_slots, slots))))
            for line in lines.values():
                counts = {}
                for _, z in line:
                    for a, b in z:
                        counts.setdefault(a, {}).setdefault(b, 0)
                        counts[a][b] += 1
                stands = {a: max(x, key=lambda b: (x[b], b)) for a, x in counts.items()}
                kept = [(j, z) for j, z in line if all(stands[a] == b for a, b in z)]
                places.setdefault(doc_id, set()).update(j for j, _ in kept)
                used = any(z for _, z in kept)
                slots_met[doc_id] = slots_met.get(doc_id, 0) + (len(stands) if used else 0)
                same[doc_id] = same.get(doc_id, True) and not (used and any(a != b for a, b in stands.items()))
        for doc_id, found in places.items():
            if len(found) >= len(own) * 0.5:
                yield doc_id, item_id, len(found), len(own), slots_met[doc_id], same[doc_id]


def test_decontaminate_by_brute_force(spark):
    rng = random.Random(10)
    vocabulary = ["red", "Blue", "Anna", "12", "31", "7.5", "km", "%", "train", "goes", "to", "Bonn,", "and", "$40", "x"]
    benchmark = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 9, 20])))) for i in range(25)]
    docs = [(100, None), (101, ""), (102, "12 31"), (103, "x " * 400)]
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 15])))]
        text = rng.choice(benchmark)[1].split(" ")
        for _ in range(rng.choice([0, 0, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        docs.append((i, " ".join([*parts, *text, *parts])))
    table = spark.createDataFrame(benchmark, "item_id long, text string")
    got = decontam.decontaminate(docs_of(spark, docs), table).collect()
    assert sorted(map(tuple, got)) == sorted(brute_leaks(docs, benchmark))


def test_decontaminate_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs_of(spark, [(1, "a b c d e f")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.decontaminate(docs_of(spark, []), some).count() == 0


# --- chat ------------------------------------------------------------------------------------------

MESSAGES = "message_id string, parent_id string, role string, text string, score double, rank int"


def test_chat_trees(spark):
    rows = [
        ("r", None, "user", "hi <|im_end|>", 0.0), ("a", "r", "assistant", "low", 1.0), ("b", "r", "assistant", "high", 3.0),
        ("c", "b", "user", "more", 1.0), ("d", "b", "user", "best", 9.0), ("d", "b", "user", "best", 9.0),
        ("o", "gone", "assistant", None, None), ("x", "y", "user", "loop", 0.0), ("y", "x", "user", "loop", 0.0),
        (None, None, None, "<\\|im_start|>", 1.0),
    ]
    messages = spark.createDataFrame([(*r, 5) for r in rows], MESSAGES)
    best = {r.root_id: r for r in chat.read_back(chat.format_paths(messages)).collect()}
    assert set(best) == {"r", "o", "null"}
    assert [tuple(t) for t in best["r"].turns] == [("user", "hi <|im_end|>"), ("assistant", "high"), ("user", "best")]
    assert best["r"].loss_text == "high" and best["o"].turns[0].text == "" and best["null"].turns[0].text == "<\\|im_start|>"
    ranked = chat.format_paths(messages, branches=None).where("root_id = 'r'").orderBy("rank").collect()
    assert [r.leaf_id for r in ranked] == ["d", "c", "a"]


def test_chat_round_trip(spark):
    rng = random.Random(2)
    parts = ["<|", "<\\|", "<", "|", "\\", "im_end|>", "\n", "é", "<|im_start|>user\n", "<|nl|>"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
    rows = [(c, t, rng.choice(["user", "assistant", "odd\nrole<|", None]), rng.choice([text(), None])) for c in [0, 1, 2, None] for t in range(rng.randrange(1, 70))]
    rows += [(5, 0, "user", "same"), (5, 0, "user", "same"), (6, None, "assistant", "w" * 50000)]
    chains = chat.reply_chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.root_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.format_paths(chains)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((t, r is not None, r or "", x is not None, x or "") for c, t, r, x in rows if c == conv)
        assert got[f"{'none' if conv is None else conv}/1"] == [(r, x) for _, _, r, _, x in own]


def test_chat_empty_table(spark):
    assert chat.format_paths(spark.createDataFrame([], MESSAGES)).count() == 0


# --- urls ------------------------------------------------------------------------------------------

RULES = [("good.org", "/", "allow"), ("bad.org", "/", "block"), ("good.org", "/ads/", "block"), (None, "/", "block")]


def test_url_rules_and_links(spark):
    link = '<a class="x" href="{}">x</a>'.format
    rows = [
        (1, "https://WWW.Good.org/a?x#y", link("http://near.net/")), (2, "http://good.org/ads/1", None),
        (3, "http://near.net/x", link("//far.net/z")), (4, "http://far.net", ""), (5, "http://shady.net/p", link("https://bad.org/")),
        (6, "http://bad.org/q", link("http://near.net/")), (7, None, None), (8, "no scheme", ""), (9, "http://evilgood.org/", ""),
        (9, "http://evilgood.org/", ""),
    ]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, host string, rule int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_graph.filter_urls(pages, rules).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert (by[1].host, by[1].path, by[1].rule) == ("www.good.org", "/a", "good.org/")
    verdicts = {i: r.verdict for i, r in by.items()}
    assert verdicts == {1: "allow", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block", 7: "allow", 8: "allow", 9: "allow"}
    assert by[7].host == by[8].path == "" and by[3].trust > by[4].trust > 0 and by[5].distrust > 0


def test_url_verdicts_by_brute_force(spark):
    rng = random.Random(21)
    hosts = [f"{a}{b}" for a in ("", "www.", "x.") for b in ("one.org", "two.org", "three.net", "four.com", "five.com")]
    rules = [("one.org", "/", "allow"), ("www.one.org", "/p", "block"), ("two.org", "/a", "block"), ("com", "/b", "block"), ("four.com", "/b", "allow")]
    pages = []
    for i in range(60):
        url = f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/b', '/p/q', '/c'])}"
        pages.append((i, url, [rng.choice(hosts) for _ in range(rng.choice([0, 1, 3]))]))
    html = lambda to: " ".join(f"<a href='http://{h}/'>x</a>" for h in to)
    table = spark.createDataFrame([(i, u, html(to)) for i, u, to in pages], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_graph.filter_urls(table, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}

    def fit(url):
        host, _, path = url.removeprefix("http://").partition("/")
        path = "/" + path if "/" in url.removeprefix("http://") else ""
        fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, max(fits, default=None)

    judged = {i: fit(u) for i, u, _ in pages}
    names = sorted({h for h, _ in judged.values()} | {h for _, _, to in pages for h in to})
    edges = {(judged[i][0], h) for i, _, to in pages for h in to if h != judged[i][0]}

    def scores(links, verdict):
        seeds = {n: sum(h == n and best is not None and best[3] == verdict for h, best in judged.values()) for n in names}
        total = sum(seeds.values())
        seeds = {n: v / total for n, v in seeds.items()}
        rank = dict(seeds)
        for _ in range(url_graph.STEPS):
            moved = {n: 0.85 * sum(rank[a] / sum(x == a for x, _ in links) for a, b in links if b == n) for n in names}
            rest = 1 - sum(moved.values())
            rank = {n: moved[n] + rest * seeds[n] for n in names}
        return {n: len(names) * v for n, v in rank.items()}

    trust, distrust = scores(edges, "allow"), scores({(b, a) for a, b in edges}, "block")
    for i, (host, best) in judged.items():
        bad = distrust[host] >= url_graph.THRESHOLD and distrust[host] > trust[host]
        want = best[3] if best else "block" if bad else "allow"
        assert (got[i].host, got[i].rule, got[i].verdict) == (host, best and best[2], want)
    assert {got[i].verdict for i, (_, best) in judged.items() if best is None} == {"allow", "block"}


def test_url_scores_by_hand(spark):
    """Against the plain iteration in Python."""
    rng = random.Random(4)
    names = [f"h{i}" for i in range(12)]
    links = sorted({(a, b) for a, b in ((rng.choice(names), rng.choice(names)) for _ in range(30)) if a != b})
    allowed = {n: rng.randrange(3) for n in names}
    hosts = spark.createDataFrame([(n, allowed[n], 1 if n == "h3" else 0) for n in names], "host string, allowed long, blocked long")
    edges = spark.createDataFrame(links, "src string, dst string")
    got = {r.host: r for r in url_graph.host_scores(edges, hosts).collect()}

    def plain(links, seeds):
        rank = dict(seeds)
        for _ in range(url_graph.STEPS):
            moved = dict.fromkeys(names, 0.0)
            for a, b in links:
                moved[b] += 0.85 * rank.get(a, 0) / sum(x == a for x, _ in links)
            rest = 1 - sum(moved.values())
            rank = {n: moved[n] + rest * seeds.get(n, 0) for n in names}
        return rank

    total = sum(allowed.values())
    trust = plain(links, {n: v / total for n, v in allowed.items() if v})
    distrust = plain([(b, a) for a, b in links], {"h3": 1.0})
    for n in names:
        assert got[n].trust == pytest.approx(12 * trust[n]) and got[n].distrust == pytest.approx(12 * distrust[n])


def test_hash_of_base_spans(spark):
    row = pii.find_pii(docs_of(spark, [(1, "a@b.co 1.2.3.4")])).select(F.sha2(pii.spans_text(F.col("base")), 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()
