import pytest

from lodestone.session import spark_session


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def docs(spark):
    """Four documents: repeated words, one without a token, one of stop words and short words only."""
    rows = [
        (1, "Blue sky, blue sea. The sky!"),
        (2, "look at the blue bird"),
        (3, ""),
        (4, "Sea bird; sea BIRD sea"),
        (5, "the of is ab"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="session")
def queries(spark):
    """Repeated word, unknown word, stop words only, empty."""
    rows = [(1, "blue blue sky"), (2, "sea unknownword"), (3, "the of"), (4, ""), (5, "bird blue sea sky")]
    return spark.createDataFrame(rows, "query_id long, text string")


@pytest.fixture(scope="session")
def corpus_rows(spark):
    rows = [
        (1, "One", "text one", [(2, "two page"), (2, "two page"), (3, "three")]),
        (2, "Two", "text two", [(3, "three"), (2, "self")]),
        (3, "Three", "text three", []),
        (4, "Four", "", [(9, "two page")]),
    ]
    schema = "id long, title string, text string, anchor_text array<struct<id:long,text:string>>"
    return spark.createDataFrame(rows, schema)
