"""File manifests of a published directory."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dryspell.operators.listings import url_manifest


def write_file_manifest(inventory: DataFrame, path: str) -> None:
    """``path, size, mtime`` as JSON lines in path order."""
    inventory.orderBy("path").write.mode("overwrite").json(path)


def write_url_manifest(listing: DataFrame, base: str, path: str, prefix: str = "") -> None:
    """One published URL per line in key order."""
    urls = url_manifest(listing, base, prefix).orderBy("key").select("url")
    urls.write.mode("overwrite").text(path)
