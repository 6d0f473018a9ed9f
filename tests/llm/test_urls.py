import fnmatch
import random
import re

from innsight.llm import urls


def test_automaton_equals_fnmatch():
    rng = random.Random(5)
    patterns = tuple("".join(rng.choice("ab*?./") for _ in range(rng.randrange(0, 12))) for _ in range(80)) + urls.GLOBS[0][:1]
    texts = ["".join(rng.choice("abc./") for _ in range(rng.randrange(0, 14))) for _ in range(300)] + ["", "ü/a", "a" * 300]
    got = urls.Automaton(patterns).match(texts)
    for i, t in enumerate(texts):
        assert list(got[i]) == [bool(re.fullmatch("(?s)" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in p), t)) for p in patterns]
    assert fnmatch.fnmatch("ads.x", "ads.*") and urls.Automaton(()).match(["a"]).shape == (1, 0)


def test_rules_and_edges(spark):
    cases = {
        "https://WWW.Example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "http://badexample.com/en/x": ("badexample.com", "/en/x", "com/", "allow"),
        "x://a.net/es/?q#f": ("a.net", "/es/", "net/es/", "block"),
        "x://a.net/EN/": ("a.net", "/EN/", None, "allow"),
        "x://ads-1.org": ("ads-1.org", "", None, "block"),
        "http://com": ("com", "", None, "allow"),
        "http://u@ads-1.org.:80/a?utm_source=x&b=1#t": ("u@ads-1.org.:80", "/a", None, "block"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://a.org/" + "x" * 20000 + ".exe": ("a.org", "/" + "x" * 20000 + ".exe", None, "block"),
    }
    df = spark.createDataFrame([(u,) for u in cases] + [("no scheme",)], "url string").selectExpr("*", "1 AS host", "2 AS verdict")
    got = urls.with_verdict(df).collect()
    assert len(got) == len(cases) + 1 and got[0].asDict().keys() == {"url", "host", "verdict", "judged"}
    for r in got:
        j = r.judged
        assert (j.host, j.path, j.rule, j.verdict) == cases[r.url]
    assert {r.judged.canonical for r in got if r.url and "utm" in r.url} == {"ads-1.org/a?b=1"}
    assert urls.with_verdict(df.limit(0)).collect() == []
