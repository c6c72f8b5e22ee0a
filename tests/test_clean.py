"""Raw events with every fault the pipeline has to survive."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quotelake import QualityError
from quotelake.functions import is_json
from quotelake.operators import (
    clean_events,
    enforce_contract,
    filter_ids,
    keyed_json,
    pages_to_events,
    quarantined_events,
    tag_events,
)
from quotelake.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from quotelake.__main__ import main as command_line
from quotelake.sinks import topic as topic_sink
from quotelake.sinks.topic import producer_options
from quotelake.sources import decode_events, read_events, read_pages, topic_options
from quotelake.sources import topic as topic_source
from tests.conftest import at, event, rows_of, silver, write_lines

FAULTS = [
    event(coin_id="good"),
    "this is not json",
    event(coin_id="text_price", price_usd="n/a"),
    event(coin_id="fraction", market_cap_usd=10.5, total_volume_usd=1.0e12),
    event(coin_id=None),
    event(coin_id="bad_time", event_time="yesterday"),
    event(coin_id="nan", price_usd="NaN"),
    event(coin_id="bad_update", last_updated="soon"),
    event(coin_id="offset", event_time="2024-01-01T23:30:00-02:00"),
    event(coin_id="float_rank", market_cap_rank=1.5),
    event(coin_id=""),
]


@pytest.fixture
def events(spark, tmp_path):
    write_lines(str(tmp_path / "bronze"), "a.json", *FAULTS)
    return read_events(spark, str(tmp_path / "bronze"), ingested_at=at("2024-03-01"))


def test_ansi_mode_is_on(spark):
    assert spark.sql("SELECT typeof(1)").count() == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.sql("SELECT CAST('x' AS INT)").collect()


def test_bad_records_do_not_stop_the_read(events):
    assert events.count() == len(FAULTS)
    assert "partition" not in events.columns


def test_clean_keeps_rows_with_coin_and_time(events):
    kept = {r.coin_id: r for r in clean_events(events).collect()}
    assert set(kept) == {
        "good",
        "text_price",
        "fraction",
        "nan",
        "bad_update",
        "offset",
        "float_rank",
        "",
    }
    assert kept["text_price"].price_usd is None and kept["text_price"].name == "A"
    assert kept["fraction"].market_cap_usd == 10.5
    assert kept["fraction"].total_volume_usd == 1e12
    assert math.isnan(kept["nan"].price_usd)
    assert kept["bad_update"].last_updated_ts is None
    assert str(kept["offset"].dt) == "2024-01-02"
    assert kept["float_rank"].market_cap_rank is None


def test_clean_has_the_silver_schema(events):
    got = [(f.name, f.dataType) for f in clean_events(events).schema]
    assert got == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_amounts_as_longs_lose_fractions(spark, tmp_path, events):
    path = str(tmp_path / "bronze")
    strict = {
        r.coin_id: r for r in read_events(spark, path, integral_amounts=True).collect()
    }
    assert strict["good"].market_cap_usd == 10
    assert strict["fraction"].market_cap_usd is None
    assert strict["fraction"].total_volume_usd is None
    assert strict["fraction"].price_usd == 1.5


def test_quarantine_is_what_clean_drops(events):
    dropped = quarantined_events(events).collect()
    assert sorted(r.reason for r in dropped) == ["no_coin_id", "no_event_time", "unreadable"]
    assert len(dropped) + clean_events(events).count() == events.count()
    texts = {r.reason: r.record for r in dropped}
    assert texts["unreadable"] == "this is not json"
    assert json.loads(texts["no_event_time"])["event_time"] == "yesterday"


def test_rows_that_lost_a_field_are_kept_and_tagged(events):
    status = {r.coin_id: r.status for r in tag_events(events).collect()}
    assert status["text_price"] == status["float_rank"] == "partial"
    assert status["good"] == status["fraction"] == status["nan"] == "clean"


def test_lineage_and_one_ingestion_time(events):
    sources = events.select("source_file", "ingestion_time").distinct().collect()
    assert len(sources) == 1
    assert sources[0].source_file.endswith("/partition=0/a.json")
    shown = events.select(F.col("ingestion_time").cast("string")).first()[0]
    assert shown == "2024-03-01 00:00:00"


def test_empty_bronze_gives_no_rows(spark, tmp_path):
    (tmp_path / "bronze").mkdir()
    assert clean_events(read_events(spark, str(tmp_path / "bronze"))).count() == 0


def test_topic_records_decode_like_file_lines(spark, events):
    records = spark.createDataFrame(
        [
            ("k", text if isinstance(text, str) else json.dumps(text), "t", 0, n)
            for n, text in enumerate(FAULTS)
        ],
        "key string, value string, topic string, partition int, offset long",
    ).withColumn("value", F.encode("value", "UTF-8"))
    decoded = decode_events(records, ingestion_time=F.lit(at("2024-03-01")))
    assert rows_of(clean_events(decoded), "source_file") == rows_of(
        clean_events(events), "source_file"
    )


PAGE = [
    {
        "id": "a",
        "symbol": "sa",
        "name": "A",
        "current_price": 2.5,
        "market_cap": 7,
        "total_volume": 3,
        "price_change_percentage_24h": -1.5,
        "market_cap_rank": 1,
        "last_updated": "2024-01-01T00:00:00.000Z",
        "not_used": [1, 2],
    },
    {"id": "b", "current_price": 1},
]


@pytest.mark.parametrize("page_per_file", [False, True])
def test_pages_become_events(spark, tmp_path, page_per_file):
    text = json.dumps(PAGE, indent=2 if page_per_file else None)
    (tmp_path / "page.json").write_text(text)
    pages = read_pages(spark, str(tmp_path / "page.json"), page_per_file=page_per_file)
    events = pages_to_events(
        pages,
        poll_time=F.lit(at("2024-01-01T00:00:00.5")),
        run_id=F.lit("r"),
        source="api",
        vs_currency="eur",
    )
    assert events.columns == BRONZE_SCHEMA.fieldNames()
    first, second = sorted(events.collect(), key=lambda r: r.coin_id)
    assert first.price_usd == 2.5 and first.market_cap_usd == 7 and first.vs_currency == "eur"
    assert first.event_time == "2024-01-01T00:00:00.500000+00:00"
    assert second.symbol is None and second.price_usd == 1.0


def test_a_page_loses_fields_but_no_objects(spark, tmp_path):
    lines = [
        '[{"id": "a", "current_price": "n/a"}, {"id": "b", "current_price": 1}]',
        '[{"id": "cut"}, {"id": "off"',
        '[{}, {"id": "c", "market_cap": 7.5}]',
        "[]",
    ]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    pages = read_pages(spark, str(tmp_path)).collect()
    assert sorted((r.id or "", r.current_price, r.market_cap) for r in pages) == [
        ("", None, None),
        ("a", None, None),
        ("b", 1.0, None),
        ("c", None, 7.5),
    ]


def test_keyed_json_spells_out_nulls(spark):
    events = spark.createDataFrame(
        [
            tuple(event(coin_id=c, symbol=s)[n] for n in ("coin_id", "symbol"))
            for c, s in [("a", "x"), ("", "x"), (None, "x"), (None, ""), ("", None)]
        ],
        "coin_id string, symbol string",
    )
    for name in BRONZE_SCHEMA.fieldNames():
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast(BRONZE_SCHEMA[name].dataType))
    got = keyed_json(events).collect()
    assert [r.key for r in got] == ["a", "x", "x", "unknown", "unknown"]
    assert list(json.loads(got[0].value)) == BRONZE_SCHEMA.fieldNames()
    assert json.loads(got[0].value)["name"] is None


@pytest.mark.parametrize("ids", [["b"], ["b"] + [f"x{n}" for n in range(2000)], None, []])
def test_filter_ids(spark, ids):
    quotes = silver(spark, {"coin_id": "a"}, {"coin_id": "b"})
    got = {r.coin_id for r in filter_ids(quotes, ids).collect()}
    assert got == ({"b"} if ids else {"a", "b"})


def test_contract_casts_and_drops(spark):
    quotes = silver(spark, {"price_usd": 1.25})
    texts = quotes.select(*[F.col(c).cast("string").alias(c) for c in quotes.columns])
    texts = texts.withColumns({"price_usd": F.lit("many"), "extra": F.lit(1)})
    out = enforce_contract(texts.drop("ingestion_run_id"))
    assert out.columns == [
        c for c in SILVER_SCHEMA.fieldNames() if c != "ingestion_run_id"
    ]
    row = out.first()
    assert row.price_usd is None and row.market_cap_usd == 10.0 and str(row.dt) == "2024-01-01"


def test_contract_reports_missing_columns_first(spark):
    quotes = silver(spark, {}).drop("symbol", "price_usd")
    with pytest.raises(QualityError) as error:
        enforce_contract(quotes)
    assert error.value.reasons == ["missing_columns:['symbol', 'price_usd']"]


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"a": 1}', True),
        ('  {"a": {"b": [1, 2]}}  ', True),
        ('{"a": 1, "a": 2}', True),
        ('{"a": {"b": 1, "b": 2}, "_other": 5}', True),
        ("[1, 2]", True),
        ('"t"', True),
        ("3", True),
        ('{"a": 1', False),
        ('{"a": 1, "a": 2', False),
        ('{"a": 1,}', False),
        ("{'a': 1}", False),
        ('{"a": NaN}', False),
        ('{"a": {"b": [1,2}}', False),
        ('{"a": "x\ny"}', False),
        ("oops {", False),
        ("", False),
        (None, False),
    ],
)
def test_what_counts_as_json(spark, text, valid):
    row = spark.createDataFrame([(text,)], "value string").select(is_json(F.col("value"))).first()
    assert row[0] is valid


def test_topic_options():
    """The calls themselves need the connector, which is not here."""
    assert topic_options("b:1,c:2", "t") == {"kafka.bootstrap.servers": "b:1,c:2", "subscribe": "t"}
    full = topic_options("b:1", "t", starting="earliest", records_per_batch=10, min_partitions=4)
    assert full == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "4",
    }
    assert producer_options("b:1", "t") == {
        "kafka.bootstrap.servers": "b:1",
        "topic": "t",
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "10",
    }
    for call in (topic_options, producer_options):
        with pytest.raises(ValueError, match="servers"):
            call("", "t")


@pytest.mark.parametrize("job", ["land", "serve", "publish"])
def test_topic_commands_hand_their_settings_to_the_connector(spark, monkeypatch, tmp_path, job):
    """The command goes as far as the connector with what the environment says."""
    monkeypatch.setenv("LAKE_ROOT", str(tmp_path))
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:9092")
    monkeypatch.setenv("KAFKA_TOPIC", "quotes")
    (tmp_path / "landing/pages").mkdir(parents=True)
    asked = []
    for module, name in ((topic_source, "topic_options"), (topic_sink, "producer_options")):
        known = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, known=known, **k: asked.append(a) or known(*a, **k))
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        command_line([job])
    assert asked == [("broker:9092", "quotes")]


@pytest.mark.parametrize(
    "text",
    ['[{"coin_id": "a"}, {"coin_id": "b", "price_usd": "x"}]', '[{"coin_id": "a"}]', "[]", "", "  ", '[{"coin_id": ', "7"],
)
def test_topic_and_file_give_the_same_rows(spark, tmp_path, text):
    (tmp_path / "f.json").write_text(text + "\n")
    lines = read_events(spark, str(tmp_path)).drop("source_file", "ingestion_time")
    records = spark.createDataFrame([("t", 0, 0, text)], "topic string, partition int, offset long, value string")
    topic = decode_events(records).drop("source_file", "ingestion_time")
    assert rows_of(lines) == rows_of(topic)
    assert lines.count() == {"[": text.count("{") or text.count("]") == 0, "": 0, " ": 0, "7": 1}[text[:1]]
