import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import pytest  # noqa: E402

from cobasket.llm import common  # noqa: E402

SCHEMA = "doc_id long, text string, n_tokens long, id string, kept boolean"

LONG = " ".join(f"wörd{i % 700}x{i % 13}" for i in range(30_000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog, again and again.", None, "", "   ", "\t\n", "a",
    "The  quick brown\tfox jumps over the lazy dog, again and again.", "Ünïcode ΑΣ İstanbul ‘quotes’ 漢字 кириллица 🙂🙂",
    "it's they'll WE'VE 3rd 1,000.50 %%% !!! <|endoftext|> x<|startoftext|>y <s> </s>", "a" * 3000, "ab" * 1500 + " ▁▁ x",
    " lead and trail ", "é" * 700, LONG, "The quick brown fox jumps over the lazy dog, again and again.",
]


@pytest.fixture(scope="session")
def spark():
    from cobasket.session import build_session

    session = build_session("llm-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    common.ship(session)
    yield session


def table(spark, texts, schema=SCHEMA):
    """Documents with distinct ids, with columns that an operator might use itself."""
    rows = [(i, t, -1, "x", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, TEXTS)


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])
