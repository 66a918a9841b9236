"""Land the adapter's records as JSON once per session and test-table
folder, and build the curated tables from them once."""
from __future__ import annotations

import os

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from clipstar.plans import adapters
from clipstar.plans.build import Curated, export, full_rebuild, incremental_update
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET
from clipstar.session import scratch_path, working_session
from clipstar.sources.landing import land_json

_ROOTS: dict[tuple[str, str], str] = {}
_LANDED: set[tuple[str, str, str]] = set()
_BUILT: dict[tuple[str, str], Curated] = {}
_INCREMENTS: dict[tuple[str, str], list[Curated]] = {}
EVENT_SPLIT_DATE = "2024-01-16"
_EXPORTED: dict[tuple[str, str], dict[str, str]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir)


_ADAPTED = {MEDIA_DATASET: adapters.landed_snapshots, EVENT_DATASET: adapters.landed_events}


def _land(spark: SparkSession, sf_dir: str, root: str, dataset: str, where: Column | None = None) -> None:
    records = _ADAPTED[dataset](working_session(spark), sf_dir, placed=True, where=where)
    land_json(records, root, dataset, compression="gzip", placed=True)


def landing_root(spark: SparkSession, sf_dir: str, *datasets: str) -> str:
    """The landing zone, with these datasets landed (all, if none is named)."""
    key = _key(spark, sf_dir)
    if key not in _ROOTS:
        _ROOTS[key] = scratch_path(spark, "landing")
    for dataset in datasets or _ADAPTED:
        if (*key, dataset) not in _LANDED:
            _land(spark, sf_dir, _ROOTS[key], dataset)
            _LANDED.add((*key, dataset))
    return _ROOTS[key]


def curated(spark: SparkSession, sf_dir: str) -> Curated:
    key = _key(spark, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = full_rebuild(spark, landing_root(spark, sf_dir), scratch_path(spark, "curated"),
                                   channel_mapping=adapters.channel_mapping(spark, sf_dir))
    return _BUILT[key]


def exported(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Folders of the Gold tables, for the catalog."""
    key = _key(spark, sf_dir)
    if key not in _EXPORTED:
        _EXPORTED[key] = export(curated(spark, sf_dir), scratch_path(spark, "gold"))
    return _EXPORTED[key]


def incremental(spark: SparkSession, sf_dir: str) -> list[Curated]:
    """The tables built from the earlier landings, and after each of two folds of the later ones."""
    key = _key(spark, sf_dir)
    if key not in _INCREMENTS:
        first, second = scratch_path(spark, "landing-a"), scratch_path(spark, "landing-b")
        early_ev = F.col("load_date") < F.lit(EVENT_SPLIT_DATE).cast("date")
        early_sn = F.col("ingest_seq") % 2 == 0
        for root, events, snapshots in ((first, early_ev, early_sn), (second, ~early_ev, ~early_sn)):
            _land(spark, sf_dir, root, MEDIA_DATASET, snapshots)
            _land(spark, sf_dir, root, EVENT_DATASET, events)
        out, mapping = scratch_path(spark, "incremental"), adapters.channel_mapping(spark, sf_dir)
        _INCREMENTS[key] = [full_rebuild(spark, first, out, channel_mapping=mapping),
                            *[incremental_update(spark, second, out, channel_mapping=mapping) for _ in range(2)]]
    return _INCREMENTS[key]
