import itertools
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from txwarden.llm.hosts import NUMBER, RULES, Settings, host_words, judged_urls, says_unwanted, viterbi, word_counts

SCHEMA = "page_id long, url string, html string, host string, n int"


def by_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path)) if fits else None


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def test_viterbi_against_all_splits():
    counts = {"free": 50, "bets": 20, "be": 90, "ts": 5, "a": 100, "the": 300, "rest": 10, "there": 8, "st": 40}
    total = float(sum(counts.values()))
    logs = {w: math.log(n / total) for w, n in counts.items()}
    value = lambda parts: sum(logs.get(p, math.log(10 / total) - len(p) * math.log(10)) for p in parts)
    for label in ("freebets", "therest", "thebe", "abets", "zq", "there", "xfree", ""):
        splits = []
        for n in range(len(label)):
            for cuts in itertools.combinations(range(1, len(label)), n):
                edges = [0, *cuts, len(label)]
                splits.append([label[i:j] for i, j in itertools.pairwise(edges)])
        got = viterbi(label, logs, total)
        assert "".join(got) == label
        assert value(got) == pytest.approx(max(map(value, splits), default=0))


URLS = [
    "http://a.example.com/en/1", "https://www.example.com/en/2", "http://x.www.example.com/en/", "http://Example.COM/EN/3", "http://b.net/es/1?x", "http://b.net/fr#x",
    "http://b.net/fr/y", "http://c.org/en/9", "http://www.freebets.org/en/1", "http://bigcasino.org/de/4", "http://casinogreat.org/de/77", "http://great.org/de/5",
    "ftp://u@h.net:80/es/", "nothing", None, "", "://", "http://", "a://b://c.com/x", "http://com/", "http://com", "http://notcom/", "http://q.org?u=http://z.com/", "http://d\n.org/\n/e", "http://ü.org/straße/12ab",
]


def test_rules_hosts_and_paths(spark):
    text, clean = "<p>the great big casino and the free bets are big and great</p>" * 3, "the great big and so on org"
    rows = [(i, u, text if i in (8, 9, 10) else clean if i % 3 else None, "clash", 1) for i, u in enumerate(URLS)]
    rows += [(100 + i, f"http://m{'' if i % 2 else 'a'}.great.org/{'en' if i % 4 else 'de'}/{i}", "clean words", None, 0) for i in range(60)]
    rows += [(7, "http://c.org/en/9", "", None, 0), (None, "http://e.net/es/", None, None, None)]
    got = judged_urls(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.page_id is not None, r.page_id or 0) for r in got) == sorted((r[0] is not None, r[0] or 0) for r in rows)
    urls = {r[0]: r[1] for r in rows}
    verdicts = {}
    for r in got:
        host, path = cut(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        found = by_rule(host, path)
        assert r.rule == (found.host + found.path if found else None)
        assert r.verdict == (found.verdict if found else ("block" if r.score > 0 else "allow"))
        verdicts[urls[r.page_id]] = r.verdict
    assert [verdicts[URLS[i]] for i in (8, 9)] == ["block"] * 2
    assert [verdicts[URLS[i]] for i in (7, 11)] == ["allow"] * 2
    assert judged_urls(spark.createDataFrame([], SCHEMA)).collect() == []


def test_scores_against_counting_by_hand(spark):
    settings = Settings(unwanted=("spam",))
    hosts = ["spam-a.org", "spam-b.org", "good.org", "fine.net"]
    rows = [(i, f"http://{hosts[i % 4]}/{'xx' if i % 5 else 'yy'}/{i}", None, None, 0) for i in range(40)]
    tokens = {r[0]: [x for x in re.split(r"[.-]", cut(r[1])[0])] + [NUMBER if x.isdigit() else x for x in re.findall(r"[0-9]+|[a-z]+", cut(r[1])[1])] for r in rows}
    text = "<b title='spam'>good</b> fine {} org net a b"
    is_block = {i: i % 4 == 0 or i % 7 == 0 for i in tokens}  # by the text alone, spam.org's or not
    pages = [(r[0], r[1], text.format("Spam" if is_block[r[0]] else "spams"), *r[3:]) for r in rows]
    got = judged_urls(spark.createDataFrame(pages, SCHEMA), settings).collect()
    b, a = Counter(), Counter()
    for i, t in tokens.items():
        (b if is_block[i] else a).update(t)
    size = len(b | a)
    for r in got:
        want = math.log((sum(is_block.values()) + 1) / (sum(not x for x in is_block.values()) + 1))
        want += sum(math.log((b[t] + 1) / (sum(b.values()) + size)) - math.log((a[t] + 1) / (sum(a.values()) + size)) for t in tokens[r.page_id])
        assert r.score == pytest.approx(want)


def test_labels_come_from_the_text(spark):
    rows = [("one casino " + "word " * 998,), ("one casino " + "word " * 999,), ("casinos freely",), ("<a casino>",), (None,), ("",), ("é7",), ("a-FREE-b",)]
    frame = spark.createDataFrame(rows, "html string")
    assert [r[0] for r in frame.select(says_unwanted(F.col("html"), Settings())).collect()] == [True, False, False, False, False, False, False, True]
    assert not any(r[0] for r in frame.select(says_unwanted(F.col("html"), Settings(unwanted=()))).collect())


def test_verdicts_differ_from_the_list(spark):
    """A name without a listed word is blocked for the company it keeps; one with a listed word is allowed if its pages are clean."""
    bad, good = "jackpot slots casino lucky", "lucky organic farm jackpot vegetables slots market"
    pages = [(i, f"http://luckyjackpot{i}.org/slots/{i}", bad) for i in range(40)]
    pages += [(100 + i, f"http://organicfarm{i}.org/market/{i}", "organic vegetables market " * 400) for i in range(60)]
    pages += [(200, "http://jackpotslots.org/slots/9", "organic market"), (201, "http://farmmarket.org/market/1", None), (202, "http://x.org/y", good)]
    got = {r.page_id: r.verdict for r in judged_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), Settings(rules=())).collect()}
    assert got[200] == "block" and got[201] == "allow"
    assert {got[i] for i in range(40)} == {"block"} and {got[100 + i] for i in range(60)} == {"allow"}


def test_long_words_and_long_unknown_runs(spark):
    word, odd = "abcde" * 9, "qz" * 200  # 45 letters; 400 letters of no word
    total = 1000.0
    logs = {word: math.log(50 / total), "free": math.log(9 / total)}
    assert viterbi(word + "free", logs, total) == [word, "free"]
    assert viterbi("free" + odd, logs, total) == ["free", odd] and viterbi(odd, logs, total) == [odd]
    pages = spark.createDataFrame([(1, f"{word} free " * 9)], "page_id long, html string")
    hosts = spark.createDataFrame([(f"{word}free.org",)], "host string")
    assert host_words(hosts, word_counts(pages), Settings()).first().host_words[:2] == [word, "free"]


def test_word_counts(spark):
    rows = [(1, "<p class='no'>One two, TWO</p>"), (2, None), (3, "two é three<br>x" + "y" * 40 + " z" + "y" * 63)]
    got = {r.word: r.n for r in word_counts(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert got == {"one": 1, "two": 3, "three": 1, "x" + "y" * 40: 1}


def test_hosts_with_digits_users_ports_and_other_letters(spark):
    want = {
        "bestcasino24.net": ["best", "casino", NUMBER, "net"], "freepills4u.org": ["free", "pills", NUMBER, "u", "org"],
        "user@bigcasino.net": ["big", "casino", "net"], "a@b:c@bigcasino.net:8080": ["big", "casino", "net"],
        "best_free-pills.org:": ["best", "free", "pills", "org"], "10.0.0.7:80": [NUMBER] * 4, "casinoüü.org": ["casino", "üü", "org"],
        "Ünet.org": ["ü", "net", "org"], "net24org": ["net", NUMBER, "org"], "great.net": ["great", "net"],
    }
    text = "best big casino free pills net org great u " * 30
    counts = word_counts(spark.createDataFrame([(1, text)], "page_id long, html string"))
    hosts = spark.createDataFrame([(h,) for h in [*want, "", "__"]], "host string")
    got = {r.host: r.host_words for r in host_words(hosts, counts, Settings()).collect()}
    assert got == want
    unwanted = ("casino", "pills")
    rows = [(i, f"http://{h}/x", text if any(w in h for w in unwanted) else "great net org", None, 0) for i, h in enumerate(want)]
    text = [(99, None, text, None, 0)]  # words only
    scores = {r.page_id: r.score for r in judged_urls(spark.createDataFrame(rows + text, SCHEMA), Settings(rules=())).collect()}
    judged = dict(zip(want, (scores[i] for i in range(len(want))), strict=True))
    assert all(judged[h] > judged["great.net"] for h in want if "casino" in h or "pills" in h)
