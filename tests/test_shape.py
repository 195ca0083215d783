import pytest
from pyspark.sql import functions as F

from inkmill.functions import fixed
from inkmill.operators import dedup, shape


@pytest.mark.parametrize(
    ("chunk", "want"),
    [
        ("The Old Mill\n\nIt stood by the river.", "The Old Mill"),
        ("THE MILL OF\nx", "THE MILL OF"),
        ("it was the best of the mills in town. Then it fell down.", "it was best of mills town."),
        ("one two three four five six seven eight nine ten", "one two three four five six seven eight"),
        ("", ""),
    ],
)
def test_topic(one, chunk, want):
    assert one(shape.topic, chunk) == want


def test_derived_prompt(spark):
    rows = [("First one. Second.", "A b. This last sentence has six words"), ("First one. Second.", "Too short. No"), ("no mark here", None), ("First. x", "")]
    df = spark.createDataFrame(rows, "c string, b string")
    got = [r[0] for r in df.select(shape.derived_prompt(df["c"], df["b"])).collect()]
    assert got == ["This last sentence has six words", "First one.", "no mark here", "First."]


def test_sentiment(one):
    label = fixed.SENTIMENTS
    assert one(shape.sentiment, "battle and fight and joy") == label["action"]
    assert one(shape.sentiment, "fear fear fear, joy, hope") == label["positive"]
    assert one(shape.sentiment, "dread") == label["negative"]
    assert one(shape.sentiment, "joy and fear and war") == label["neutral"]
    assert one(shape.sentiment, "") == label["neutral"]


def test_entities(spark):
    text = "Mira Stone met Roland. Later Roland joined the Silver Hand Order and the old guild. Chapter Four began. Tom sat. Tom ran. Ab Cde."
    names, orgs = spark.createDataFrame([(text,), (None,)], "x string").select(shape.entities("x").alias("e")).first()["e"]
    assert "Roland" in names and "Mira Stone" in names
    assert "Chapter Four" not in names and "Tom" not in names and "Ab Cde" not in names
    assert any("Order" in o for o in orgs) and names == sorted(names) and orgs == sorted(orgs)


@pytest.mark.parametrize(
    ("entity", "sound"),
    [("Mira", True), ("ab", False), ("Guild", False), ("the Critical Role crew", False), ("42", False), ("campaign two", False), ("Exandrian", False), ("Ian", True), ("a\nb c", False), ("Dan Brian", True)],
)
def test_valid_entity(one, entity, sound):
    assert one(shape.valid_entity, entity) is sound


def test_dpo_and_tokens(spark):
    conv = "conversations array<struct<from string, value string>>"
    rows = [(1, [("human", "q"), ("gpt", "a"), ("gpt", "b")]), (2, [("human", "q")]), (3, None), (4, [("system", "s"), ("human", None), ("gpt", "x" * 4000)])]
    df = spark.createDataFrame(rows, f"id int, {conv}")
    got = {r["id"]: r for r in shape.dpo(df, "id").collect()}
    assert set(got) == {1, 4} and got[1]["rejected"] == "a" and got[1]["rejected_system"] == "" and got[4]["prompt"] == ""
    kept = {r["id"]: r["tokens"] for r in shape.within_tokens(df).collect()}
    assert 4 not in kept and kept[1] == 1


def test_canonical_keys(one):
    assert one(shape.canonical_keys, '{"好感度變化": 1, "x": [{"NPC態度": 2}]}') == '{"好感度增量": 1, "x": [{"NPC回應": 2}]}'
    assert one(shape.canonical_keys, "no json") == "no json"
    assert one(shape.canonical_keys, "3") == "3"


def test_first_of_each_with_hot_and_null_keys(spark):
    rows = [(i, "hot") for i in range(300)] + [(1000, None), (1001, None), (7, "b")]
    df = spark.createDataFrame(rows, "id int, k string").repartition(5)
    assert sorted(r["id"] for r in dedup.first_of_each(df, F.col("k"), "id").collect()) == [0, 7, 1000, 1001]


def test_copies_and_links(spark):
    df = spark.createDataFrame([("a ",), ("a",), ("b",), (None,)], "t string")
    assert tuple(dedup.copies(df, "t").first()) == (3, 2, 1)
    new = spark.createDataFrame([("http://x/a/",), ("http://x/b",), (None,)], "url string")
    assert [r[0] for r in dedup.new_links(new, spark.createDataFrame([("http://x/a",)], "url string")).collect()] == ["http://x/b"]


def test_cleaned_analyst(spark):
    """Invalid entities go, records without any go, other values and records of sentiment stay."""
    def talk(system, *answers):
        return [("system", system), ("human", "h"), *[("gpt", a) for a in answers]]

    mood = f"x{fixed.SENTIMENT_MARKS[0]}"
    rows = [
        (1, talk("ner", '{"角色": ["Mira", "12", 5, "a\\nb"], "組織": [], "n": 3}')), (2, talk("ner", "no json")), (3, talk("ner", "[1]")), (4, talk("ner", '{"角色": ["7"], "組織": []}')),
        (5, talk(mood, "anything")), (6, talk("ner")), (7, talk("ner", "first", '{"組織": ["Lantern Guild"]}')), (8, None), (9, []),
    ]
    df = spark.createDataFrame(rows, "id long, conversations array<struct<from string, value string>>")
    got = {r["id"]: r["conversations"][-1]["value"] for r in shape.cleaned_analyst(df).collect()}
    assert got == {1: '{"角色": ["Mira"], "組織": [], "n": 3}', 5: "anything", 7: '{"組織": ["Lantern Guild"]}'}


def test_canonical_reasoning(spark):
    old, new = next(iter(fixed.REASONING_KEYS.items()))
    rows = [(1, [("gpt", f'{{"{old}": [{{"{old}": 1}}]}}'), ("gpt", f'{{"{old}": 1}}')]), (2, [("gpt", "plain")]), (3, [("human", f'{{"{old}": 1}}')]), (4, None)]
    df = spark.createDataFrame(rows, "id long, conversations array<struct<from string, value string>>")
    got = {r["id"]: r["conversations"] and [t["value"] for t in r["conversations"]] for r in shape.canonical_reasoning(df).collect()}
    assert got == {1: [f'{{"{new}": [{{"{new}": 1}}]}}', f'{{"{old}": 1}}'], 2: ["plain"], 3: [f'{{"{old}": 1}}'], 4: None}


def test_lore(spark):
    rows = [("Mira Vell met Mira Vell at Dusk Gate. The Lantern Guild waited, and The Man left.", "en"), ("Zora Quill", "fr"), (None, "en")]
    got = {tuple(r) for r in shape.lore(spark.createDataFrame(rows, "text string, language string")).collect()}
    assert {("person", "Mira Vell"), ("person", "Dusk Gate")} <= got and any(k == "faction" and "Lantern Guild" in n for k, n in got)
    assert not any("Zora" in n for _, n in got)
