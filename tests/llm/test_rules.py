"""Quality rules, URL rules and toxicity."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations, product

import pytest

from conftest import SMALL
from llm.conftest import SCHEMA, corpus, prose
from matchday.llm import quality, toxicity, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


def apart(left, right):
    a, b = sum(left), sum(right)
    if not a or not b:
        return 0.0
    total = 0.0
    for x, y in zip(left, right):
        p, q = x / a, y / b
        total += (p * math.log2(2 * p / (p + q)) if p else 0) + (q * math.log2(2 * q / (p + q)) if q else 0)
    return math.sqrt(max(total / 2, 0))


def classes(text):
    found = [0] * 6
    for c in text or "":
        if WORD.match(c) is None:
            found[4] += 1
        elif "A" <= c <= "Z":
            found[1] += 1
        elif "0" <= c <= "9":
            found[2] += 1
        elif "!" <= c <= "~" and not c.isalpha():
            found[3] += 1
        elif c > "\x7f":
            found[5] += 1
        elif "a" <= c <= "z":
            found[0] += 1
    return found


def judge(rows):
    common = {}
    for _, text, lang, *_ in rows:
        common.setdefault(lang or "", Counter()).update(WORD.findall(text or ""))
    best = {lang: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:16]] for lang, c in common.items()}

    def heard(text, lang):
        words = WORD.findall(text or "")
        own = [words.count(w) for w in best[lang or ""]]
        own += [0] * (16 - len(own))
        return [*own, len(words) - sum(own)]

    sums = {}
    for _, text, lang, *_ in rows:
        for place, values in enumerate((classes(text), heard(text, lang))):
            old = sums.setdefault((lang or "", place), [0] * len(values))
            sums[lang or "", place] = [x + y for x, y in zip(old, values)]
    found = []
    for doc_id, text, lang, *_ in rows:
        base = counts(text)
        c, w = apart(classes(text), sums[lang or "", 0]), apart(heard(text, lang), sums[lang or "", 1])
        near = c <= quality.MAX_CHARACTERS and w <= quality.MAX_WORDS_APART + quality.SLACK / math.sqrt(max(1, base[0]))
        found.append((doc_id, *base, not base[-1] and near, round(c, 9), round(w, 9)))
    return found


def quality_rows():
    rng = random.Random(1)
    rows = [(i, t, rng.choice(["en", "de", None]), "s", 1) for i, t in corpus()]
    rows += [(900 + i, "A! # " * 60 + prose(rng, 60), "en", "s", 1) for i in range(3)]
    rows += [(950, "same line here\n" * 9 + prose(rng, 80), "en", "s", 1), (951, "a b c d " * 40, "de", "s", 1)]
    rows += [(960, "a b c x a b c y a b c " + prose(rng, 70), "en", "s", 1)]
    return rows


def test_quality_against_plain_python(spark):
    rows = quality_rows()
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n_words", "2 as classes", "3 as language")
    result = quality.judged(table).collect()
    found = [(*tuple(r)[:8], round(r.characters_apart, 9), round(r.words_apart, 9)) for r in result]
    assert sorted(map(str, found)) == sorted(map(str, judge(rows)))
    assert {r.kept for r in result} == {True, False}


def test_quality_of_given_documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text", "lang").collect()]
    found = [(*tuple(r)[:8], round(r.characters_apart, 9), round(r.words_apart, 9)) for r in quality.judged(table).collect()]
    assert sorted(map(str, found)) == sorted(map(str, judge(rows)))


def test_long_words_and_many_languages(spark):
    """Common words may be of any length and script, and every language has a reference of its own."""
    rng = random.Random(6)
    frequent = ["который", "поскольку", "однако", "через", "между", "должен", "говорить", "сегодня"]

    def text(own, other, words=150):
        return " ".join(rng.choice(own) if rng.random() < 0.6 else rng.choice(other) for _ in range(words))

    rows, odd = [], []
    for number in range(90):
        shift = [chr(0x0430 + (ord(c) - 0x0430 + number) % 32) for c in "".join(frequent)]
        own = ["".join(shift[i * 6 : i * 6 + 6]) for i in range(8)]
        rare = [f"слово{number}а{i}" for i in range(300)]
        rows += [(number * 100 + i, text(own, rare), f"l{number}", "s", 1) for i in range(6)]
        # in the same script, of words that the language does not have
        odd.append(number * 100 + 50)
        rows.append((odd[-1], text(rare, [f"чужое{i}" for i in range(300)]), f"l{number}", "s", 1))
    result = quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in result if not r.kept} == set(odd)
    found = [(*tuple(r)[:8], round(r.characters_apart, 9), round(r.words_apart, 9)) for r in result]
    assert sorted(map(str, found)) == sorted(map(str, judge(rows)))


def test_quality_of_nothing(spark):
    assert quality.judged(spark.createDataFrame([], SCHEMA)).collect() == []


URLS = [
    None, "", "nothing", "http://", "http://a.com", "http://a.com/", "HTTPS://WWW.Example.COM/en/x?y#z", "http://example.com/en/",
    "http://notexample.com/en/", "http://x.www.example.com/en/1", "http://example.com/EN/", "http://a.net/es/", "http://net/fr/1",
    "http://a.net/de/", "x://b.org?q=1/en/", "http://a.net#/es/", "http://a.com:80/", "http://\u00c9x.net/es/\nq", "a://b://c.net/es/",
    "//a.net/es/", "http://a.net/es", "http://net.org/es/",
]


def by_list(url):
    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = re.split(r"[?#]", rest[end:], maxsplit=1)[0]
    fits = [
        (len(at + start), at + start, verdict) for at, start, verdict in url_rules.LIST
        if (host == at or host.endswith("." + at)) and path.startswith(start)
    ]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_listed_urls(spark):
    rows = [(i, url) for i, url in enumerate(URLS)] + [(None, URLS[4]), (3, URLS[3]), (3, "http://twice.org/")]
    table = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as tokens", "3 as token")
    labels = spark.createDataFrame([(1, True), (2, None), (None, True)], "page_id long, block boolean")
    result = url_rules.judge_urls(table, labels).drop("confidence").collect()
    expected = []
    for page_id, url in rows:
        host, path, rule, verdict = by_list(url)
        expected.append((page_id, host, path, rule, verdict or "allow"))
    assert sorted(map(str, (tuple(r) for r in result))) == sorted(map(str, expected))
    assert url_rules.judge_urls(table.limit(0), labels.limit(0)).collect() == []


def test_late_and_long_tokens_are_mined(spark):
    long = "z" * 150
    rows = []
    for i in range(120):
        fill = "/".join(f"a{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + k)}x" for k in range(26))
        # beyond 24 tokens in order, and beyond 100 characters
        tail = ("/zbad", f"/{long}", "/zgood")[i % 3]
        rows.append((i, f"http://h{i}.org/{fill}{tail}?late={i}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 3 < 2) for i, _ in rows], "page_id long, block boolean")
    mined = {tuple(r.antecedent): r.confidence for r in url_rules.mined(url_rules.parsed(pages), labels).collect()}
    assert mined[("p=zbad",)] == 1.0
    judged = {r.page_id: r.verdict for r in url_rules.judge_urls(pages, labels).collect()}
    assert judged == {i: "block" if i % 3 < 2 else "allow" for i, _ in rows}


def test_urls_that_share_many_tokens(spark):
    """Thirty words in all blocked URLs are one rule and not two to the power of thirty."""
    words = "/".join(f"w{chr(97 + i)}x" for i in range(26)) + "/wab/wac/wad/wae"
    rows = [(i, f"http://a{i}.org/{words}/{i}") for i in range(60)]
    rows += [(100 + i, f"http://b{i}.org/other/{'wax' if i % 2 else 'way'}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i < 100) for i, _ in rows], "page_id long, block boolean")
    mined = url_rules.mined(url_rules.parsed(pages), labels).collect()
    assert [list(r.antecedent) for r in mined] == [["p=#"]]
    judged = url_rules.judge_urls(pages, labels)
    assert {r.page_id: r.verdict for r in judged.collect()} == {i: "block" if i < 100 else "allow" for i, _ in rows}


def test_mined_rules_against_all_combinations(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(800):
        host, lang, kind = rng.choice(["a", "b", "c"]), rng.choice(["x", "y"]), rng.choice(["shop", "news", "wiki"])
        rows.append((i, f"http://{host}.example.org/{lang}/{kind}/{i}?ref=1"))
        if i % 4:
            labels.append((i, (host == "a" and kind == "shop") or rng.random() < 0.1))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame(labels, "page_id long, block boolean")
    parsed = url_rules.parsed(pages)
    tokens = {r.page_id: r.tokens for r in parsed.collect()}
    support = max(url_rules.SUPPORT, url_rules.LEAST_URLS / len(labels)) * len(labels)
    seen, bad = Counter(), Counter()
    for page_id, block in labels:
        for size in range(1, len(tokens[page_id]) + 1):
            for items in combinations(tokens[page_id], size):
                seen[items] += 1
                bad[items] += block
    expected = {
        items: bad[items] / seen[items] for items in seen
        if bad[items] >= support - 1e-9 and bad[items] / seen[items] >= url_rules.CONFIDENCE
    }
    # tokens of the same URLs count as one, and only the smallest combinations stay
    members = {}
    for page_id, _ in labels:
        for token in tokens[page_id]:
            members.setdefault(token, set()).add(page_id)
    first = {token: min(t for t in members if members[t] == own) for token, own in members.items()}
    expected = {items: share for items, share in expected.items() if all(first[t] == t for t in items)}
    expected = {
        items: share for items, share in expected.items() if not any(set(other) < set(items) for other in expected)
    }
    mined = url_rules.mined(parsed, table).collect()
    assert expected and {tuple(r.antecedent): r.confidence for r in mined} == pytest.approx(expected)
    singles = Counter(t for page_id, _ in labels for t in tokens[page_id])
    assert all(singles[r.rarest] == min(singles[t] for t in r.antecedent) for r in mined)
    blocked = {r.page_id for r in url_rules.judge_urls(pages, table).where("verdict = 'block'").collect()}
    assert blocked == {i for i, t in tokens.items() if any(set(items) <= set(t) for items in expected)}
    assert {i for i, url in rows if "//a." in url and "shop" in url} <= blocked


READER = toxicity.Reader({})


def strength(text):
    return toxicity.text_score(text, READER)


def test_grammar():
    weight, lone, full = toxicity.BUILT_IN_WEIGHT, toxicity.LONE, toxicity.TARGETED
    assert strength(None) == strength("") == strength("the clowned morons") == 0
    assert strength("what an idiot") == strength("What an IDIOT!!!") == weight * lone
    assert strength("you idiot") == strength("idiot that you are") == weight * full
    # a target in another clause is none
    assert strength("idiot, you") == weight * lone
    assert strength("not an idiot") == weight * lone * toxicity.NEGATED
    assert strength("you are not an idiot") == pytest.approx(weight * full * toxicity.NEGATED)
    assert strength("he said: idiot") == weight * lone and strength("it said idiot") == weight * lone * toxicity.REPORTED
    assert strength("I will kill") == strength("you kill") == strength("kill. you") == 0
    assert strength("I will kill you") == toxicity.THREAT * full
    assert strength("I will not kill you") == pytest.approx(toxicity.THREAT * full * toxicity.NEGATED)
    assert strength("an idiot, a moron") == 2 * weight * lone
    # the words alone are the same, the clauses are not
    assert strength("it wrote you are not an idiot") < strength("an idiot") < strength("you are an idiot")


def clauses(seed):
    rng = random.Random(seed)
    for _ in range(400):
        kinds = rng.choices(toxicity.CLASSES, [6, 2, 1, 1, 1, 1], k=rng.randrange(1, 12))
        yield [(kind, rng.choice([1.0, 2.5, 4.0]) if kind == toxicity.INSULT else 0.0, False) for kind in kinds]


def test_clauses_by_definition():
    """Each paid word by what stands within reach of it."""
    reach = toxicity.REACH
    for clause in clauses(1):
        kinds, total = [kind for kind, *_ in clause], 0.0
        for i, (kind, weight, _) in enumerate(clause):
            if kind not in toxicity.PAID:
                continue
            before, after = kinds[max(0, i - reach) : i], kinds[i + 1 : i + 1 + reach]
            factor = toxicity.NEGATED if toxicity.NEGATE in before else 1.0
            factor *= toxicity.REPORTED if toxicity.REPORT in kinds[:i] else 1.0
            if kind == toxicity.INSULT:
                targeted = toxicity.TARGET in before or toxicity.TARGET in after
                total += weight * factor * (toxicity.TARGETED if targeted else toxicity.LONE)
            elif toxicity.TARGET in after:
                total += toxicity.THREAT * factor * toxicity.TARGETED
        assert toxicity.clause_score(clause) == pytest.approx(total)


def test_composition_against_all_paths():
    """Every path of the transducers side by side, without composing them."""

    def paths(states, clause):
        if not clause:
            ended = all(state in accepted for state, (_, accepted, _) in zip(states, toxicity.TRANSDUCERS))
            return [0.0] if ended else []
        (kind, weight, _), rest = clause[0], clause[1:]
        paid = weight if kind == toxicity.INSULT else toxicity.THREAT if kind == toxicity.THREATEN else 0.0
        found = []
        for choice in product(*[arcs[state][kind] for state, (_, _, arcs) in zip(states, toxicity.TRANSDUCERS)]):
            factor = math.prod(factor for _, factor in choice)
            found += [paid * factor + score for score in paths([state for state, _ in choice], rest)]
        return found

    for clause in clauses(2):
        every = paths([start for start, *_ in toxicity.TRANSDUCERS], clause)
        assert toxicity.clause_score(clause) == pytest.approx(max(every, default=0.0))


def test_learned_words_and_held_out_labels(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 5 == 0
        words = prose(rng, 60, 3000).split()
        if toxic:
            for stem in rng.choices(["grumpf", "zarkle"], k=3):
                words[rng.randrange(60)] = stem + rng.choice(["", "a", "en"]) + rng.choice(["", ",", "."])
        rows.append((i, " ".join(words), "en", "s", 1))
        out = zlib.crc32(str(i).encode()) % 4 == 2
        # labels that are held out lie, and nothing may be learned from them
        labels.append((i, int(toxic != out)))
    rows += [(None, None, None, None, None), (None, "", "", "", 0), rows[0]]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as toxic", "2 as strength", "3 as score")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    result = toxicity.toxicity(table, known).collect()
    assert len(result) == len(rows)
    for r in result:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.predicted == int(r.doc_id is not None and r.doc_id % 5 == 0)
    kept = toxicity.without_toxic(table, known)
    assert kept.columns == table.columns
    assert kept.count() == sum(1 for r in result if not r.predicted)


def test_without_labels_or_documents(spark):
    table = spark.createDataFrame([(1, "you idiot, you moron, scum", "en", "s", 1), (2, "fine", "en", "s", 1)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.doc_id: r.predicted for r in toxicity.toxicity(table, none).collect()} == {1: 1, 2: 0}
    assert toxicity.toxicity(table.limit(0), none).collect() == []
    assert toxicity.without_toxic(table.limit(0), none).collect() == []
