"""Explorer pages that open only the files they need (L1, L2 over the manifest written at publish)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripmart.operators.explorer import Cursor, explorer_page, files_in_order
from tripmart.operators.mart import explorer_view
from tripmart.operators.metrics import DashboardFilters, ExplorerFilters
from tripmart.plans.warehouse import Warehouse
from tripmart.schema import PAGE_SIZE


@dataclass(frozen=True)
class FilePage:
    rows: DataFrame  # at most one page
    files: int  # opened in the last round


def page_over_files(wh: Warehouse, filters: DashboardFilters, explorer: ExplorerFilters, cursor: Cursor | None = None,
                    direction: str = "next", page_size: int = PAGE_SIZE, first_files: int = 4) -> FilePage:
    """The page of ``explorer_page`` from as few files as settle it.

    Files are opened in the order of the cursor. A page is settled if it is full, more rows follow, and all its
    rows lie strictly before every unopened file; otherwise four times as many files are opened, so that filters
    which few rows pass cost a few rounds, not a round per file. The driver sees one page and the names of the
    opened files.
    """
    in_order = files_in_order(wh.table("fact_files"), filters, cursor, direction)
    take = first_files
    while True:
        listed = in_order.limit(take + 1).collect()
        opened, unopened = listed[:take], listed[take:]
        facts = wh.store.read_files("fact_trips", [(f.source_month, f.file_name) for f in opened], wh.snapshot)
        page = explorer_page(explorer_view(facts, wh.dims), filters, explorer, cursor, direction, page_size)
        rows = page.collect()
        if not unopened or (rows and rows[0].has_more and _before(rows, unopened[0], direction)):
            return FilePage(wh.spark.createDataFrame(rows, page.schema), len(opened))
        take *= 4


def _before(rows: list, file, direction: str) -> bool:
    if direction == "next":
        return rows[-1].pickup_at_local < file.first_pickup
    return rows[0].pickup_at_local > file.last_pickup
