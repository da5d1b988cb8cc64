"""Column roles.

The tender tables carry Korean column names; every operator takes column
names as parameters, and these dataclasses hold the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TenderColumns:
    # Column names of the notice and bid tables.
    key: str = "공고번호"
    title: str = "공고제목"
    agency: str = "발주처(수요기관)"
    region: str = "지역제한"
    base: str = "기초금액"
    estimate: str = "예정가격"
    range_text: str = "예가범위"
    a_value: str = "A값"
    bid_rate: str = "투찰률(%)"
    n_bidders: str = "참여업체수"
    mark: str = "공고구분표시"
    rate_text: str = "기초대비 사정률(%)"
    rate: str = "사정률"

    @property
    def notice_required(self) -> list[str]:
        return [self.key, self.title, self.agency, self.region, self.base, self.estimate,
                self.range_text, self.a_value, self.bid_rate, self.n_bidders, self.mark]

    @property
    def bid_required(self) -> list[str]:
        return [self.key, self.rate_text]


@dataclass(frozen=True)
class ColumnRoles:
    """Roles for the generic clean / transform / feature plan."""
    key: str | None = "공고번호"
    dedupe_key: str | None = None          # set for notice tables, empty for bid tables (Q21)
    essential: tuple[str, ...] = ("공고번호",)
    log: tuple[str, ...] = ()
    scale: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    date: tuple[str, ...] = ()
    target: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    exclude_keywords: tuple[str, ...] = ("id", "ID", "번호", "index")
    order_cols: tuple[str, ...] = field(default_factory=tuple)


# Name keywords used to pick amount, text and date columns.
AMOUNT_KEYWORDS = ("금액", "price", "amount", "비용")
TEXT_KEYWORDS = ("제목", "내용", "설명", "title", "content", "항목", "공고")
DATE_KEYWORDS = ("date", "날짜", "일자", "시작일", "종료일")


def require_columns(df, cols, name: str = "table") -> None:
    """B1: plan-time check, no job; the error lists the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{name}: missing columns {missing}")
