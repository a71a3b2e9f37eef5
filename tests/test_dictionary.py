"""Names of places and countries found in names, against patterns tried one by one."""

import random
import re

from pyspark.sql import functions as F

from rookery.functions import rules, values
from rookery.operators import places


def test_other_countries_equal_patterns(spark):
    r = random.Random(7)
    some = ["South Africa", "spain", "New Zealand", "club", "Brazil2", "_Peru", "São", "Tomé", "CHILE", "Niger", "Nigeria", "united", "Kingdom", "Mexico-City", "é"]
    rows = [(r.choice([" ", "-", "  ", " / "]).join(r.choices(some, k=r.randint(0, 5))), r.choice(["ES", "ZA", None, "BR"])) for _ in range(600)]
    rows += [(n, cc) for cc, n, _ in values.COUNTRIES] + [(f"x{n}", "XX") for _, n, _ in values.COUNTRIES] + [(f"({n})", "XX") for _, n, _ in values.COUNTRIES]
    rows += [(None, "ES"), ("", "ES")]
    got = spark.createDataFrame(rows, "n string, cc string").select("n", "cc", rules.names_other_country(F.col("n"), F.col("cc")).alias("x")).collect()

    def plain(name, cc):
        has = lambda n: re.search(rf"(?<![A-Za-z0-9_]){re.escape(n)}(?![A-Za-z0-9_])", name or "", re.IGNORECASE)
        return next((n for c, n, _ in values.COUNTRIES if c != (cc or "") and has(n)), None)

    assert [r.x for r in got] == [plain(r.n, r.cc) for r in got]


def test_city_names_with_one_hot_first_word(spark):
    r = random.Random(8)
    names = [f"San {w}" for w in ("Juan", "José del Cabo", "Luis", "Luis Potosí")] + ["San", "Nueva San Luis", "Ávila", "Los Altos"]
    dimension = spark.createDataFrame([("MX", n, i + 1) for i, n in enumerate(names)] + [("ES", "San Juan", 1)], "cc string, name string, rank int")
    words = ["San", "san", "Luis", "Potosi", "Juan", "jose", "del", "cabo", "Avila!", "Club", "Nueva", "los", "Altos"]
    rows = [(i, r.choice(["MX", "ES", "FR"]), " ".join(["San"] * r.randint(0, 2) + r.choices(words, k=r.randint(0, 7)))) for i in range(800)]
    rows += [(-1, "MX", None), (-2, None, "San Juan"), (-3, "MX", "")]
    got = {x.key: x.city for x in places.named_in(spark.createDataFrame(rows, "key long, cc string, name string"), dimension, ["key"]).collect()}
    flat = lambda s: " ".join(re.findall("[a-z0-9]+", s.lower().translate(str.maketrans("áéíóú", "aeiou"))))

    def plain(cc, name):
        fit = [(-len(flat(n)), rank, n) for c, n, rank in dimension.collect() if c == cc and len(flat(n)) >= 4 and f" {flat(n)} " in f" {flat(name or '')} "]
        return min(fit)[2] if fit else None

    dimension.collect = lambda found=dimension.collect(): found
    assert got == {k: plain(cc, n) for k, cc, n in rows if plain(cc, n)}
