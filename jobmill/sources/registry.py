"""All sources of a run, in the order in which they write to the job table.

A landed payload names its source; payloads of another kind (detail pages, a second list
form) name the part as well, ``themuse/details``. An adapter gets its source's parts and
what a run knows besides: the time and lookup tables such as company names per board.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import boards, lists, pages, thread

NAMES = "request_key string, company_name string"
SITES = f"{NAMES}, base_url string, site_number string"


@dataclass
class Landed:
    """The landed payloads of one source, counted while an adapter reads them."""

    landing: DataFrame
    source: str
    as_of: Column
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    counters: dict[str, Observation] = field(default_factory=dict)

    def part(self, name: str = "") -> DataFrame:
        """Payloads of a part that were fetched well; "" is the source's own list."""
        full = f"{self.source}/{name}" if name else self.source
        good = F.coalesce(F.col("status") < 400, F.lit(True))
        own = self.landing.filter(F.col("source") == full)
        if full not in self.counters:
            self.counters[full] = Observation(f"payloads of {full}")
        counted = own.observe(
            self.counters[full], F.count(F.lit(1)).alias("payloads"), F.count_if(~good).alias("failed")
        )
        return counted.filter(good)

    def table(self, schema: str = NAMES) -> DataFrame:
        """The lookup table of the source; empty if the run has none."""
        found = self.tables.get(self.source)
        return self.landing.sparkSession.createDataFrame([], schema) if found is None else found


Adapter = Callable[[Landed], DataFrame]


@dataclass(frozen=True)
class Source:
    """One source: its adapter, and whether a run may leave it out to save time."""

    name: str
    adapter: Adapter
    slow: bool = False


def _plain(read: Callable[..., DataFrame], *args) -> Adapter:
    return lambda x: read(x.part(), *args)


def _dated(read: Callable[..., DataFrame], **options) -> Adapter:
    return lambda x: read(x.part(), as_of=x.as_of, **options)


def _named(read: Callable[..., DataFrame]) -> Adapter:
    """Boards with company names and a detail page per posting."""
    return lambda x: read(x.part(), x.table(), x.part("details"))


def _detailed(read: Callable[..., DataFrame]) -> Adapter:
    return lambda x: read(x.part(), x.part("details"))


def _either(api: Adapter, pages_of: Callable[[Landed], DataFrame]) -> Adapter:
    """Postings of the JSON form and of the pages form, which land as parts."""
    return lambda x: api(x).unionByName(pages_of(x))


def _visible(name: str, level: str) -> Source:
    return Source(name, _plain(lists.visible_list, name, level))


def _table(name: str, read: Callable[..., DataFrame]) -> Source:
    return Source(name, _dated(partial(read, source=name)))


#: Fixed order: of two sources that write a posting in one run, the later one owns it.
SOURCES = [
    _visible("pittcsc", "new_grad"),
    _visible("simplify_internships", "internship"),
    Source("vanshb03_newgrad", _dated(lists.active_list, source="vanshb03_newgrad")),
    Source("vanshb03_internships", _dated(lists.active_list, source="vanshb03_internships", level="internship")),
    Source("ambicuity", lambda x: lists.lock_table(x.part(), x.as_of, x.part("json"))),
    _table("speedyapply_ai_newgrad", lists.apply_cell_table),
    Source("speedyapply_swe_newgrad", _dated(lists.headed_table)),
    _table("jobright_swe", lists.repeated_company_table),
    _table("jobright_data", lists.repeated_company_table),
    _table("jobright_business", lists.repeated_company_table),
    _table("jobright_design", lists.repeated_company_table),
    _table("jobright_marketing", lists.repeated_company_table),
    _table("jobright_accounting", lists.repeated_company_table),
    _table("jobright_pm", lists.repeated_company_table),
    Source("zapplyjobs", _dated(lists.last_link_table)),
    Source("hackernews", _plain(thread.comment_thread)),
    Source("adzuna", _plain(boards.adzuna)),
    Source("remoteok", _plain(boards.remoteok)),
    Source("arbeitnow", _plain(boards.arbeitnow)),
    Source("themuse", _detailed(boards.themuse)),
    Source("jobspy", _plain(boards.jobspy)),
    Source("greenhouse", _plain(boards.greenhouse)),
    Source("lever", _plain(boards.lever)),
    Source("workday", lambda x: pages.workday(x.part(), x.part("details"), x.as_of)),
    Source("workable", _plain(boards.workable)),
    Source("recruitee", _plain(boards.recruitee)),
    Source("smartrecruiters", _detailed(boards.smartrecruiters)),
    Source("ziprecruiter", _plain(boards.record_export, "ziprecruiter"), slow=True),
    Source("glassdoor", _plain(boards.record_export, "glassdoor"), slow=True),
    Source("careerjet", _plain(boards.careerjet)),
    Source("workatastartup", lambda x: boards.workatastartup(x.part(), x.part("pages"), x.part("details"))),
    Source("builtin", _either(_plain(boards.builtin_api), lambda x: pages.builtin_pages(x.part("pages")))),
    Source("dice", _either(_dated(boards.dice_api), lambda x: pages.dice_pages(x.part("pages"), x.as_of))),
    Source("simplyhired", _dated(pages.simplyhired)),
    Source("handshake", _plain(boards.handshake), slow=True),
    Source("ashby", lambda x: boards.ashby(x.part(), x.table())),
    Source("bamboohr", lambda x: pages.bamboohr(x.part(), x.part("careers")), slow=True),
    Source("breezy", _named(pages.breezy)),
    Source("icims", _named(pages.icims)),
    Source("jazzhr", _named(pages.jazzhr)),
    Source("jobvite", _named(pages.jobvite)),
    Source("oraclecloud", lambda x: pages.oraclecloud(x.part(), x.table(SITES), x.part("details"))),
    Source("personio", _plain(pages.personio)),
    Source("dice_rss", _plain(pages.dice_rss), slow=True),
    Source("usajobs", _plain(boards.usajobs)),
]


def chosen(names: Sequence[str] | None = None, skip_slow: bool = False) -> list[Source]:
    """Sources by name, in the order of a run; all of them without names."""
    known = {s.name for s in SOURCES}
    if unknown := set(names or ()) - known:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    return [s for s in SOURCES if (names is None or s.name in names) and not (skip_slow and s.slow)]
