"""robots.txt first-hit rules (golden cases)."""
import pytest

from sitegraph.operators import robots as R

NL = "\n"
CASES = [
    # body, url, agent, allowed
    ("User-agent: *" + NL + "Allow: /en/1" + NL + "Disallow: /en" + NL, "https://h.org/en/12", "bot", True),
    ("User-agent: *" + NL + "Allow: /en/1" + NL + "Disallow: /en" + NL, "https://h.org/en/2", "bot", False),
    ("User-agent: *" + NL + "Disallow: /en" + NL + "Allow: /en/1" + NL, "https://h.org/en/12", "bot", False),
    ("User-agent: *" + NL + "Disallow:" + NL, "https://h.org/x", "bot", False),   # empty Disallow
    ("User-agent: other" + NL + "Disallow: /" + NL, "https://h.org/x", "bot", True),
    ("User-agent: a" + NL + "User-agent: bot" + NL + "Disallow: /x" + NL, "https://h.org/x", "bot", False),
    ("User-agent: bot" + NL + "User-agent: a" + NL + "Disallow: /x" + NL, "https://h.org/x", "bot", True),
    ("# c" + NL + "  USER-AGENT: BOT  " + NL + " disallow: /de " + NL, "https://h.org/de/1", "bot", False),
    ("User-agent: *" + NL + "Disallow: /x" + NL, "https://h.org:8080/x", "bot", True),  # port
    ("User-agent: bot" + NL + "Disallow: /x" + NL, "https://h.org/x", None, True),
    ("", "https://h.org/x", "bot", True),
]


@pytest.mark.parametrize("body,url,agent,allowed", CASES)
def test_robots_first_hit(spark, body, url, agent, allowed):
    robots = spark.createDataFrame([("https://h.org", body)], "origin string, body string")
    urls = spark.createDataFrame([(url,)], "url string")
    assert R.robots_allowed(urls, robots, agent).first()["allowed"] is allowed


def test_no_body_means_allowed(spark):
    robots = spark.createDataFrame([("https://other.org", "User-agent: *\nDisallow:\n")], "origin string, body string")
    urls = spark.createDataFrame([("https://h.org/x",)], "url string")
    assert R.robots_allowed(urls, robots, "bot").first()["allowed"] is True


def _plain(rules, rest):
    """First rule, in order of lines, that ``rest`` begins with."""
    for rule, path in rules:
        if rest.startswith(path):
            return rule == "allow"
    return True


def test_index_equals_the_rules_in_order(spark):
    """Thousands of rules, nested and alike, against URLs that hit, pass by and equal them."""
    import random
    rng = random.Random(3)
    parts = ["a", "ab", "abc", "b", "é", "%41", "~", "-", "zz"]

    def path():
        return "/" + "/".join(rng.choice(parts) + rng.choice(["", str(rng.randrange(40))]) for _ in range(rng.randrange(1, 6)))
    bodies, urls, want = [], [], {}
    for k, n in enumerate([0, 1, 2, 7, 300, 10_000]):
        rules = [(rng.choice(["allow", "disallow"]), path()[: rng.randrange(1, 30)]) for _ in range(n)]
        if k == 3:
            rules.insert(4, ("allow", ""))
        origin = f"https://h{k}.org"
        bodies.append((origin, "User-agent: *\n" + "\n".join(f"{r}: {p}" for r, p in rules)))
        for i in range(400):
            rest = rng.choice(rules)[1] + rng.choice(["", "/", "x", "~~"]) if rules and i % 2 else path()
            urls.append((len(urls), origin + rest))
            want[len(urls) - 1] = _plain(rules, rest)
    got = R.robots_allowed(spark.createDataFrame(urls, "i int, url string"), spark.createDataFrame(bodies, "origin string, body string"), "bot")
    assert {r.i: r.allowed for r in got.collect()} == want and len(set(want.values())) == 2


def test_cost_of_a_url_does_not_follow_the_number_of_rules(spark):
    """The row expression reads a chain and a few paths: no filter runs over all rules."""
    robots = spark.createDataFrame([("https://h.org", "User-agent: *\nDisallow: /x")], "origin string, body string")
    df = R.allowed_by_rules(spark.createDataFrame([("https://h.org/x",)], "url string"), R.rules_by_origin(robots, "bot"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(_rules" not in plan and "filter(rules" not in plan and "log2" in plan.lower()


def test_empty_disallow_hits_urls_of_another_spelling(spark):
    robots = spark.createDataFrame([("https://h.org", "User-agent: *\nDisallow: /x\nDisallow:\n"), ("https://i.org", "User-agent: *\nDisallow: /\n")],
                                   "origin string, body string")
    urls = spark.createDataFrame([("HTTPS://h.org/y",), ("HTTPS://i.org/y",)], "url string")
    assert {r.url: r.allowed for r in R.robots_allowed(urls, robots, "bot").collect()} == {"HTTPS://h.org/y": False, "HTTPS://i.org/y": True}
