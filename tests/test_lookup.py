"""Terms found by lookup against their patterns alone, and where rows are worked on."""

import random
import re

from pyspark.sql import functions as F

from foliant.functions import match as M
from foliant.functions import score as S
from foliant.functions.literals import needed
from foliant.plans import queries as Q
from foliant.plans import synthetic as Y
from foliant.vocab import Vocabulary, gates, keywords, topics

ODD = Vocabulary.parse("""
Straße: strasse, große straße
Kelvin: k, i̇d, ſ
Sigma: σίσυφος, ς, σ-x
Mark: é, é, a‿b, ½
Root: √, √z, |0⟩
""")
PIECES = ["K", "ſ", "İd", "ı", "Straße", "STRASSE", "ẞ", "ﬁ", "Σx", "Σ-X", "ΣΊΣΥΦΟΣ", "ς", "é", "É", "√Z", "(√z)", "|0⟩", "a|0⟩b", "rx(θ)", "RX(Θ)gate", "rx(ϑ)  gate", "π/8", "a‿b", "½", "x́", "_x", "x_", "X²", "gate", "gates", "Controlled", "not", "-", " ", "\n", " ", ".", "controlled not", "C-NOT", "swap  gate", "and gate", "Pauli-X"]


def _texts(n):
    rng = random.Random(5)
    terms = [t for v in (gates(), topics(), ODD) for _, t in v.terms()]
    return ["", *("".join(rng.choice([rng.choice(PIECES), rng.choice(terms), rng.choice(terms).upper()]) + rng.choice(["", " ", " ", "-", ",", "_"]) for _ in range(rng.randrange(1, 9))) for _ in range(n))]


def test_lookup_finds_what_the_patterns_find(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_texts(1500))], "id int, t string").repartition(4).cache()
    for v in (gates(), topics(), ODD, Vocabulary(gates().entries[:9], "s?")):
        plain = F.array_sort(F.filter(F.array(*(F.when(F.col("t").rlike(M.FLAGS + p), F.lit(c)) for c, p in v.patterns())), lambda x: x.isNotNull()))
        rows = df.select("t", plain.alias("plain"), M.find_terms(F.col("t"), v).alias("found"), F.array_sort(F.array_distinct(F.transform(M.locate_terms(F.col("t"), v), lambda m: m["canonical"]))).alias("located")).collect()
        assert [r for r in rows if not r["plain"] == r["found"] == r["located"]] == []
        assert sum(len(r["plain"]) for r in rows) > 300


def test_words_and_patterns_are_the_plain_ones(spark):
    k = keywords()
    df = spark.createDataFrame([(t,) for t in _texts(600)], "t string").select(F.lower("t").alias("t")).repartition(4).cache()
    for words in (k.secondary, k.entities):
        plain = F.filter(F.array(*(F.when(F.col("t").rlike(rf"(?U)\b{re.escape(w)}\b"), F.lit(w)) for w in words)), lambda x: x.isNotNull())
        assert df.select(plain.alias("a"), S._words(F.col("t"), words).alias("b")).where("a <> b").count() == 0
    patterns = S.FOR + S.AGAINST + S.DESCRIBES
    assert all(needed(p) for p in patterns) and needed("a?b*|c") == () and needed("(?:ab|cd)+x?") == ("ab", "cd")
    texts = [x for p in patterns for x in (needed(p)[-1], re.sub(r"\\s[+*]", " ", re.sub(r"\(\?:([^|()]*)[^()]*\)\??", r"\1", p)).replace("\\", ""))]
    both = spark.createDataFrame([(t,) for t in texts], "t string").unionByName(df)
    plain = F.filter(F.array(*(F.when(F.col("t").rlike("(?U)" + p), F.lit(p)) for p in patterns)), lambda x: x.isNotNull())
    assert both.select(plain.alias("a"), S._matching(F.col("t"), patterns).alias("b")).where("a <> b").count() == 0


def test_captions_of_one_file_are_spread_and_filters_stay_behind(spark, sf_dir):
    assert Y.frame(spark, sf_dir, "captions").rdd.getNumPartitions() >= 4
    plan = Q.algorithm_infer(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "contains" not in plan[plan.index("Exchange RoundRobin") :].lower()
