"""Quoted names of a feed's databases and tables, and where its landing files lie."""

import re
from enum import StrEnum

PLAIN = re.compile(r"[a-z_]\w*", re.ASCII | re.IGNORECASE)
MAX_RUN_ID = 256


class Layer(StrEnum):
    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"
    OPS = "ops"


def dotted(*parts: str) -> str:
    """The parts as one quoted SQL name; parts that are not plain words are refused."""
    odd = [part for part in parts if not PLAIN.fullmatch(part)]
    if odd:
        raise ValueError(f"not plain names: {odd}")
    return ".".join(f"`{part}`" for part in parts)


def check_run_id(value: str) -> str:
    if not value or len(value) > MAX_RUN_ID:
        raise ValueError(f"run id must have 1 to {MAX_RUN_ID} characters")
    return value


class FeedConfig:
    """One database for each layer, ``<catalog>.<prefix>_<layer>``, and the landing folder.

    ``table_format`` is the word after USING: any format the session knows that takes
    INSERT OVERWRITE with a static partition."""

    def __init__(
        self,
        landing: str = "",
        catalog: str = "spark_catalog",
        prefix: str = "tripfold",
        table_format: str = "parquet",
    ):
        dotted(prefix, table_format)
        self.landing = landing
        self.table_format = table_format
        self._databases = {layer: dotted(catalog, f"{prefix}_{layer}") for layer in Layer}

    def name(self, layer: str, *table: str) -> str:
        """The quoted name of a layer's database, or of a table in it."""
        return ".".join([self._databases[Layer(layer)], *map(dotted, table)])
