"""Words found in the source data and words written to results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Vocabulary:
    yes: str
    cancelled: str
    stage_won: str
    stage_lost: str
    paid: str
    paid_late: str
    bands: tuple[str, str, str, str]
    # Call reasons; the first two take a number.
    reason_quiet: tuple[str, str]
    reason_overdue: tuple[str, str]
    reason_slower: str
    reason_likely: str
    advice_quiet: str
    advice_overdue: str
    advice_slower: str
    advice_likely: str

    @property
    def closed_stages(self) -> tuple[str, str]:
        return (self.stage_won, self.stage_lost)


# Words of the original ERP/CRM extracts and of the call list.
PORTUGUESE = Vocabulary(
    yes="S",
    cancelled="Cancelado",
    stage_won="Fechado ganho",
    stage_lost="Fechado perdido",
    paid="Pago",
    paid_late="Pago com atraso",
    bands=("Fria", "Morna", "Quente", "Muito quente"),
    reason_quiet=("Sem comprar há ", " dias — cliente em risco"),
    reason_overdue=("Atrasado ", "x em relação ao próprio ciclo de compra"),
    reason_slower="Reduziu o ritmo de compra nos últimos 90 dias",
    reason_likely="Alta propensão de compra segundo o modelo",
    advice_quiet="Ligar para reativar e entender o motivo do afastamento",
    advice_overdue="Oferecer reposição do pedido habitual",
    advice_slower="Apresentar novidades e reforçar contato",
    advice_likely="Aproveitar o momento para ampliar o pedido",
)

ENGLISH = Vocabulary(
    yes="S",
    cancelled="Cancelled",
    stage_won="Closed won",
    stage_lost="Closed lost",
    paid="Paid",
    paid_late="Paid late",
    bands=("Cold", "Warm", "Hot", "Very hot"),
    reason_quiet=("No purchase for ", " days, client at risk"),
    reason_overdue=("Late by ", "x against the usual buying cycle"),
    reason_slower="Bought nothing in the last 90 days",
    reason_likely="High purchase propensity",
    advice_quiet="Call to win back and learn why they left",
    advice_overdue="Offer to refill the usual order",
    advice_slower="Show what is new and stay in touch",
    advice_likely="Use the moment to widen the order",
)
