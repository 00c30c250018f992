"""Measures, date roles, slicers and comparisons on the planted bank."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerflow.plans import measures as M
from ledgerflow.plans import reports, summaries


def test_totals_agree_with_summaries(golden):
    total = M.measure(golden.mart, M.TRANSACTIONS, ["nb_transactions", "montant_debits", "flux_net"]).first()
    summary = summaries.transactions(golden.mart).first()
    assert total.nb_transactions == summary.nombre_transactions == 15000
    assert total.montant_debits == summary.montant_total_debits == Decimal("116950.00")
    assert total.flux_net == Decimal("66100.00") - Decimal("116950.00")


def test_rates(golden):
    r = M.measure(golden.mart, M.REPAYMENTS, ["nb_impayes", "taux_impaye", "nb_retards"]).first()
    assert (r.nb_impayes, r.nb_retards) == (103, 7282) and r.taux_impaye == 103 / 18899
    assert M.measure(golden.mart, M.TRANSACTIONS, ["taux_rejet"]).first().taux_rejet == 371 / 15000


def test_cuts_add_up(golden):
    for by in (["annee_mois"], ["region", "segment"], ["famille_produit", "annee", "tranche_revenu"], ["canal", "niveau_risque"]):
        cut = M.measure(golden.mart, M.TRANSACTIONS, ["nb_transactions"], by)
        assert cut.agg({"nb_transactions": "sum"}).first()[0] == 15000


def test_date_roles_differ(golden):
    octroi = M.measure(golden.mart, M.CREDITS, ["production_credit"], ["annee"]).collect()
    fin = M.measure(golden.mart, M.CREDITS, ["production_credit"], ["annee"], date_role="fin_prevue").collect()
    assert {r.annee for r in octroi} == {2021, 2022} and {r.annee for r in fin} == {2025, 2026}
    assert sum(r.production_credit for r in octroi) == sum(r.production_credit for r in fin)


def test_slicers(golden):
    one = M.measure(golden.mart, M.REPAYMENTS, ["nb_echeances"], [], {"statut_remboursement": ["Impayé"], "annee": [2023, 2024]})
    by = M.measure(golden.mart, M.REPAYMENTS, ["nb_impayes"], ["annee"]).where("annee in (2023, 2024)")
    assert one.first().nb_echeances == by.agg({"nb_impayes": "sum"}).first()[0]


def test_unknown_attribute_is_an_error(golden):
    with pytest.raises(ValueError, match="segment"):
        M.measure(golden.mart, M.TARGETS, ["objectif_revenu"], ["segment"])


def test_performance_keeps_every_side(golden):
    rows = M.performance(golden.mart, ["agence_id"]).collect()
    assert len(rows) == 26
    known = next(r for r in rows if r.agence_id == "A001")
    assert known.ecart_revenu == known.revenu_realise - known.objectif_revenu
    unknown = next(r for r in rows if r.agence_id == "INCONNUE")
    assert unknown.taux_realisation_production_credit is None and unknown.production_credit > 0


def test_slicer_without_relation_leaves_targets_whole(golden):
    whole = M.performance(golden.mart, []).first()
    sliced = M.performance(golden.mart, [], {"segment": "Association"}).first()
    assert sliced.objectif_revenu == whole.objectif_revenu and sliced.revenu_realise == 0


def test_prior_year_handles_gaps(spark):
    rows = [(dt.date(2023, 1, 1), 10), (dt.date(2024, 1, 1), 15), (dt.date(2024, 2, 1), 7), (dt.date(2025, 1, 1), 0)]
    out = {r.mois_debut: r for r in M.prior_year(spark.createDataFrame(rows, "mois_debut date, v int"), "v").collect()}
    assert out[dt.date(2024, 1, 1)].evolution_v_pct == 0.5
    assert out[dt.date(2024, 2, 1)].v_annee_precedente is None
    assert out[dt.date(2025, 1, 1)].evolution_v == -15


def test_reports_run(golden):
    assert reports.top_branches(golden.mart, 3).count() == 3
    assert reports.branches_to_watch(golden.mart).where("a_surveiller").count() >= 0
    detail = reports.branch_detail(golden.mart, "A003").collect()
    assert len({r.mois_debut for r in detail}) == len(detail) > 40
    bands = {r.tranche_revenu: r.nb_clients_distincts for r in reports.clients_by(golden.mart, "tranche_revenu").collect()}
    assert sum(bands.values()) == 6000 and bands["Inconnu"] == 7
