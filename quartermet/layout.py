"""Where the zones lie: one object used by writers and readers alike."""

from __future__ import annotations

from dataclasses import dataclass

from .model import CURATED_TABLES, RAW_ROOT, product_schema


@dataclass(frozen=True)
class Layout:
    root: str

    def raw(self, product: str) -> str:
        product_schema(product)
        return f"{self.root}/{RAW_ROOT}/{product}"

    def staged(self, product: str) -> str:
        product_schema(product)
        return f"{self.root}/staged/{product}"

    def curated(self, table: str) -> str:
        if table not in CURATED_TABLES:
            raise ValueError(f"unknown curated table {table!r}")
        return f"{self.root}/curated/quarterly_{table}_features"

    def log(self, name: str) -> str:
        return f"{self.root}/log/{name}"
