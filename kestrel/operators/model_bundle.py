"""A stored model that can be scored with in another session (ML-22, ML-23).

A bundle is one committed version (`versions`): the model, as Spark ML or the network
writes it, and a metadata file with the feature contract, the locked threshold and the
dates of the splits, published together by one manifest.  The manifest holds a digest over
all files of the bundle, taken by Spark and checked before the model is loaded, so that a
bundle is used whole or not at all.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import neural, propensity
from kestrel.sources import versions

FORMAT = 1


class Damaged(RuntimeError):
    """The files of a bundle are not those that were published."""


@dataclass
class Bundle:
    model: Any
    metadata: dict
    path: str
    digest: str


def content_digest(spark: SparkSession, folder: str) -> str:
    """sha256 over the names and contents of all files below a folder; only one digest for each file reaches the driver."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rows = files.select("path", F.sha2("content", 256).alias("h")).collect()
    marker = folder.rstrip("/").rpartition("/")[2]
    lines = sorted(f"{r['path'].partition(marker)[2]} {r['h']}" for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def save(spark: SparkSession, path: str, model: Any, champion: str, threshold: float, split_dates: dict,
         classification: str = "unclassified") -> versions.Version:
    """Publish a fitted model with all that scoring needs to know."""
    kind = "network" if isinstance(model, neural.NetworkModel) else "pipeline"
    metadata = {"format": FORMAT, "champion": champion, "kind": kind, "threshold": float(threshold), "threshold_source": "validation",
                "splits": dict(split_dates), "features": list(propensity.FEATURES), "categorical": list(propensity.CATEGORICAL),
                "leakage_exclusions": list(propensity.LEAKAGE_EXCLUSIONS), "ranges": {k: list(v) for k, v in propensity.RANGES.items()},
                "data_classification": classification}

    def write(folder: str) -> dict:
        if kind == "network":
            model.write(spark, f"{folder}/model")
        else:
            model.write().save(f"{folder}/model")
        versions.create_text(spark, f"{folder}/metadata.json", json.dumps(metadata, sort_keys=True))
        return {"digest": content_digest(spark, folder), "champion": champion}
    return versions.publish(spark, path, write)


def load(spark: SparkSession, path: str) -> Bundle:
    """The current bundle, checked against the digest of its manifest."""
    v = versions.current(spark, path)
    if v is None:
        raise FileNotFoundError(f"no committed model at {path}")
    if content_digest(spark, v.path) != v.facts["digest"]:
        raise Damaged(v.path)
    metadata = json.loads(versions.read_text(spark, f"{v.path}/metadata.json"))
    if metadata["format"] != FORMAT:
        raise ValueError(f"bundle format {metadata['format']}: this version reads {FORMAT}")
    if metadata["features"] != list(propensity.FEATURES):
        raise ValueError("the stored feature contract is another one")
    read = neural.NetworkModel.read(spark, f"{v.path}/model") if metadata["kind"] == "network" else PipelineModel.load(f"{v.path}/model")
    return Bundle(read, metadata, v.path, v.facts["digest"])


def score(bundle: Bundle, requests: DataFrame) -> DataFrame:
    """Batch scoring under the stored contract and threshold."""
    return propensity.batch_score(bundle.model, requests, bundle.metadata["threshold"], bundle.metadata["features"])


def registry_row(spark: SparkSession, bundle: Bundle) -> DataFrame:
    """The registry record of a stored model."""
    m = bundle.metadata
    return propensity.registry_row(spark, m["champion"], m["threshold"], m["splits"], m["features"], m["data_classification"],
                                   bundle.path, bundle.digest)
