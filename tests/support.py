"""Rows that several tests make."""

import json
from datetime import datetime

from loomledger.plans.entities import ENTITIES
from loomledger.sources.envelope import ENVELOPE

T0 = datetime(2026, 1, 10)


def envelopes(spark, entity, payloads):
    """payloads: (ingested_at, version, batch, payload dict or text)."""
    spec = ENTITIES[entity]
    rows = [(spec.source, spec.name, at, version, batch, data if isinstance(data, str) or data is None else json.dumps(data))
            for at, version, batch, data in payloads]
    return spark.createDataFrame(rows, ENVELOPE)
