"""What the jobs work on: table names and knobs, all from the caller."""

from dataclasses import dataclass

#: The tables each job touches.
NEEDS = {
    "daily": ("daily_table",), "intraday": ("intraday_table",), "options": ("option_table",),
    "prices": ("price_table",), "market_cap": ("mcap_table",), "instruments": ("instrument_table",),
}


@dataclass(frozen=True)
class Settings:
    daily_table: str = ""
    intraday_table: str = ""
    flag_table: str = ""
    instrument_table: str = ""
    price_table: str = ""
    mcap_table: str = ""
    option_table: str = ""
    price_decimals: int = 2
    upload_mismatched: bool = True
    merge_on_read: bool = False     # the daily job records its upserts beside the daily table; `changes.compact` folds them in
    snapshots: bool = False         # new daily and instrument tables are views over snapshots, which replacing the whole table swaps
    buckets: int = 8                # of scrips, per date of a new daily or intraday table
    files_by_month: bool = True     # price and market-cap tables hold a few thousand rows a day: a directory per month

    def check(self, job: str) -> "Settings":
        """These settings, if they name every table of `job`."""
        unnamed = ", ".join(sorted(t for t in NEEDS[job] if not getattr(self, t)))
        if unnamed:
            raise ValueError(f"the {job} job writes to tables that have no name yet: {unnamed}")
        if self.merge_on_read and self.snapshots:
            raise ValueError("a table has either changes beside it (merge_on_read) or snapshots, not both")
        return self
