import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lodestone.functions.analyzers import analyze, analyzer, extract_classes
from lodestone.functions.patterns import RICH_TOKEN, SIMPLE_TOKEN, TOKEN_CLASSES, spark_pattern
from lodestone.functions.stemmer import porter_stem, stem_tokens
from lodestone.functions.words import STOPWORDS
from lodestone.operators.termstats import class_counts

ADVERSARIAL = [
    "#tag @user don't well-known 5% 1,234.56 10:30 a.m. www.site.com 12/05/2020 u.s.a. <b>x</b>",
    "Ünïcode crème brûlée 東京 ñandú ²½ x² naïve-test’s",
    "w" * 5000,
    "w" * 5000 + "%",
    "<" + "w" * 5000,
    "a-" * 5000,
    "a-" * 5000 + "%",
    "1" * 5000 + "%",
    ",123" * 5000 + "%",
    "<" + "““x”" * 3000,
    "<" + "“x" * 3000,
    "1." + "0" * 5000 + "a",
    "<a href='x > y’ b=“c > d” e> and 3 May 2020, May 3, 2020; 10.45PM 9:30 pm 12345 12,345.6 ab-cd% -5%",
]


def spark_tokens(spark, texts, pattern, lower=True):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    col = F.lower("text") if lower else F.col("text")
    found = F.regexp_extract_all(col, F.lit(spark_pattern(pattern)), F.lit(0))
    return [list(r.t) for r in df.select("id", found.alias("t")).orderBy("id").collect()]


@pytest.mark.parametrize("pattern", [SIMPLE_TOKEN, RICH_TOKEN], ids=["simple", "rich"])
def test_spark_tokens_equal_python_tokens(spark, pattern):
    random.seed(7)
    noise = ["".join(random.choice("aéB1259,.%+-'“”’<> :/amp") for _ in range(30)) for _ in range(300)]
    texts = ADVERSARIAL + noise
    assert spark_tokens(spark, texts, pattern) == [re.findall(pattern, t.lower()) for t in texts]


@pytest.mark.parametrize("table,column", [("documents", "text"), ("pages", "html")])
def test_tokens_of_test_tables(spark, table, column):
    texts = [r[0] for r in spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").select(column).collect()]
    for pattern in (SIMPLE_TOKEN, RICH_TOKEN):
        assert spark_tokens(spark, texts, pattern) == [re.findall(pattern, t.lower()) for t in texts]


def test_very_long_texts_are_tokenized_whole(spark):
    texts = ["x" * 500_000, "<" + "“" * 20_000 + "b-" * 100_000, "7," * 100_000]
    simple = spark_tokens(spark, texts, SIMPLE_TOKEN)
    assert len(simple[0]) == 20_000
    rich = spark_tokens(spark, texts, RICH_TOKEN)
    assert rich[0] == [texts[0]] and rich[1] == ["b-" * 100_000]


def test_many_open_tags(spark):
    """Linear in the text, and the same tokens as without the cut at the last >."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("<>ab '“”’-5%.,") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    got = df.select("text", analyzer("rich_stem", stopwords=[])(F.col("text")).alias("tokens"))
    plain = F.regexp_extract_all(F.lower("text"), F.lit(spark_pattern(RICH_TOKEN)), F.lit(0))
    assert got.where(F.col("tokens") != stem_tokens(plain)).count() == 0
    start = time.time()
    long = spark.createDataFrame([("a > " + "< " * 200_000 + "end",)], "text string")
    assert long.select(analyzer("rich_stem", stopwords=[])(F.col("text")).alias("t")).first().t == ["a", "end"]
    assert extract_classes(long, "text", ["html"]).count() == 0
    assert time.time() - start < 60


# The same classes spelled with plain backtracking.
BACKTRACKING = {
    "word": r"(?<![\-\w])\w+(?:\w*\-?)*'?\w*(?!\w*%)",
    "number": r"(?<![\w+\-.,])[+-]?\d{1,3}(?:,\d{3})*(?:\.\d+)?(?!\d*%|\d*\.[a-zA-Z]+|\d*,\S|\d*\.\S|\d*[a-zA-Z]+|\d)",
    "percent": r"(?<![\w+\-.,])[+-]?\d{1,3}(?:,?\d{3})*(?:\.\d+)?%(?!\d*%|\d*\.[a-zA-Z]+|\d*,\S|\d*\.\S|\d*[a-zA-Z]+)",
}


@pytest.mark.parametrize("name", BACKTRACKING)
def test_linear_patterns_match_the_same(name):
    random.seed(3)
    plain, linear = re.compile(BACKTRACKING[name]), re.compile(TOKEN_CLASSES[name])
    for _ in range(20_000):
        s = "".join(random.choice("ab-'% 1234,.+") for _ in range(random.randint(1, 14)))
        assert plain.findall(s) == linear.findall(s), s


def test_stopwords_and_options(spark):
    df = spark.createDataFrame([("The Sky's blue, 3 May 2020 <b>also</b> runs runs",)], "text string")
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 200

    def run(spec, **options):
        return list(analyze(df, "text", spec, **options).first().tokens)

    assert run("simple") == ["sky's", "blue", "2020", "runs", "runs"]
    assert run("simple", stopwords=[])[:2] == ["the", "sky's"]
    assert run("simple_stem") == ["sky'", "blue", "2020", "run", "run"]
    assert run("rich_stem") == ["sky'", "blue", "3", "2020", "<b>", "</b>", "run", "run"]
    assert run("rich_stem", any_case=True, drop_html=True) == ["sky'", "blue", "3 may 2020", "run", "run"]
    assert run(lambda c: F.split(c, " "))[0] == "The"
    with pytest.raises(KeyError):
        analyzer("nosuch")


# Words and stems published with the algorithm.
STEMS = """
caresses caress ponies poni ties tie caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc digitizer digit operator oper feudalism feudal decisiveness decis hopefulness hope
formaliti formal sensitiviti sensit triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend
adoption adopt communism commun activate activ effective effect probate probat rate rate cease ceas
controll control roll roll dying die news news geology geolog by by say say enjoy enjoy
"""


def test_porter_stems():
    words = STEMS.split()
    pairs = list(zip(words[::2], words[1::2]))
    assert [(w, porter_stem(w)) for w, _ in pairs] == pairs


def test_stem_arrays(spark):
    df = spark.createDataFrame([(1, ["cats", "hopping", "cats"]), (2, []), (3, None), (4, ["news"])], "id int, t array<string>")
    out = [r.s for r in df.coalesce(1).select("id", stem_tokens(F.col("t")).alias("s")).orderBy("id").collect()]
    assert out == [["cat", "hop", "cat"], [], None, ["news"]]


def test_class_counts(spark):
    """Matches are counted in their row; of rows that come once nothing is shuffled, others are added up, null with null."""
    rows = [(1, "12:30 May 12:30 3 May 2020"), (2, "at 7:05"), (None, "12:30 <b>"), (None, "12:30 <b> <b>"), (3, None), (4, "")]
    want = {(1, "time", "12:30", 2), (1, "date", "3 May 2020", 1), (2, "time", "7:05", 1)}
    df = spark.createDataFrame(rows, "id int, text string")
    again = class_counts(df, "text", ["time", "date", "html"])
    assert sorted(map(str, again.collect())) == sorted(map(str, class_counts(df.repartition(3), "text", ["time", "date", "html"]).collect()))
    assert {tuple(r) for r in again.collect()} == want | {(None, "time", "12:30", 2), (None, "html", "<b>", 3)}
    once = class_counts(df.where("id < 3"), "text", ["time", "date", "html"])
    assert {tuple(r) for r in once.collect()} == want
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["slash_date", "date", "time"])
def test_places_that_are_not_tried(spark, name):
    """The first characters of a pattern leave its matches as they are."""
    rng = random.Random(8)
    parts = ["1", "0", "12", "/", "05", "2020", " ", ",", "Jan", "January", "Feb", "May", "Sept", "ember", "3 May ", "12 Feb ", "March 7, ", "1995", ":", ".", "AM", "p.m.", "a", "é", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(12)) for _ in range(4000)]
    plain = F.regexp_extract_all("text", F.lit(spark_pattern(TOKEN_CLASSES[name])), F.lit(0)).alias("want")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = sorted(map(tuple, df.select("id", F.explode(plain)).collect()))
    assert want and sorted((r.id, r.value) for r in extract_classes(df, "text", [name]).collect()) == want


def test_extract_classes(spark):
    text = "www.site.com 12/05/2020 3 May 2020 10.45PM 1,234.5 7% u.s.a. well-known <b>"
    df = spark.createDataFrame([(1, text)], "id int, text string")
    found = {}
    for r in extract_classes(df, "text").collect():
        found.setdefault(r.token_class, []).append(r.value)
    assert found["website"] == ["www.site.com"] and found["slash_date"] == ["12/05/2020"]
    assert found["date"] == ["3 May 2020"] and found["time"] == ["10.45PM"]
    assert found["percent"] == ["7%"] and found["html"] == ["<b>"] and "well-known" in found["word"]
    assert "1,234.5" in found["number"] and found["abbreviation"] == ["u.s.a"]


@pytest.mark.parametrize("name", ["simple_stem", "rich_stem"])
def test_exploded_stems_are_made_once(spark, name):
    df = spark.createDataFrame([(1, "running skies"), (2, ""), (3, None)], "id long, text string")
    out = analyze(df, "text", name).select("id", F.posexplode("tokens").alias("pos", "term"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, out.collect())) == [(1, 0, "run"), (1, 1, "sky")]
