"""Small hand-made copies for tests."""

from datetime import datetime, timezone

from twinledger import schemas

ENTITY = "a.b.com"


def ms(text: str) -> str:
    """'2020-01-02 03:04:05.678' -> epoch milliseconds as text."""
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in text else "%Y-%m-%d %H:%M:%S"
    moment = datetime.strptime(text, fmt).replace(tzinfo=timezone.utc)
    return str(round(moment.timestamp() * 1000))


def quad(text: str) -> str:
    return f"{text[:4]}-T{(int(text[5:7]) - 1) // 4 + 1}"


def stage_row(key, at, source="S", quadrimester=None, entity=ENTITY, stamp=None, start_time=None, message="M"):
    return (
        entity,
        quadrimester or quad(at),
        source,
        key,
        message,
        stamp or at.replace(" ", "T"),
        ms(at) if start_time is None else start_time,
    )


def stage(spark, rows):
    return spark.createDataFrame(rows, schemas.STAGE)


def doc_row(key, at, source="S", entity=ENTITY, doc_id=None, content=None, archived="2025-06-01 00:00:00"):
    text = content or f"head X-SOURCE-ID:{source} X-REPORTING-ENTITY: {entity} body"
    parse = datetime.fromisoformat
    return (doc_id or f"{key}#{at}#{source}", key, text, parse(at), parse(archived))


def docs(spark, rows):
    return spark.createDataFrame(rows, schemas.INDEX_DOCS)
