"""The ten frames → the table store and CSV."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from postmill.schemas import PARENTS
from postmill.sources.tables import TableStore, export_csv


def load_all(frames: Mapping[str, DataFrame], store: TableStore, load_id: str | None = None) -> dict[str, DataFrame]:
    """Load parents before children; returns the rejected rows by table.

    A load that failed half-way, or that ran before, is repeated under the same ``load_id``: it leaves each row once.
    """
    load_id = uuid.uuid4().hex if load_id is None else load_id
    order = ["topics", "messages", *[t for t in PARENTS if t != "messages"]]
    loaded = {table: store.load(frames[table], table, load_id) for table in order if table in frames}
    return {table: rejected for table, rejected in loaded.items() if rejected is not None}


def export_all(store: TableStore, base: str, day: date) -> dict[str, str]:
    """Every table as one dated CSV dataset."""
    return export_csv(store.read_all(), base, day)
