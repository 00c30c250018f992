"""A generated bank with exactly known anomalies, as all-text raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AGENCY = "concat('A', lpad(cast({n} as string), 3, '0'))"


def _a(n: str) -> str:
    return AGENCY.format(n=n)


def _between(first: int, last: int) -> str:
    return f"n between {first} and {last}"


def _rows(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).withColumnRenamed("id", "n")


def planted_raw(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "agences": _agences(spark),
        "clients": _clients(spark),
        "credits": _credits(spark),
        "objectifs_agences": _targets(spark),
        "produits": _products(spark),
        "remboursements": _repayments(spark),
        "transactions": _transactions(spark),
    }


def _agences(spark):
    """25 branches, 15 with a damaged text."""
    return _rows(spark, 1, 25).selectExpr(
        f"{_a('n')} as agence_id",
        "case when n <= 15 then concat('M├⌐rignac ', n) else concat('Agence ', n) end as nom_agence",
        "concat(' Ville ', n, ' ') as ville",
        "cast(33000 + n as string) as code_postal",
        "'Gironde' as departement",
        "'Nouvelle-Aquitaine' as region",
        "cast(date_add(date'1995-08-03', cast(n * 300 as int)) as string) as date_ouverture",
        "cast(6 + n % 21 as string) as effectif",
        "element_at(array('Urbaine', 'Périurbaine', 'Rurale'), cast(n % 3 + 1 as int)) as categorie_agence",
    )


def _clients(spark):
    """6 000 clients, 60 repeated lines, 7 negative incomes, 25 postcodes and 30 emails missing."""
    once = _rows(spark, 1, 6000).selectExpr("n", "n as line")
    again = _rows(spark, 5001, 5060).selectExpr("n", "n + 10000 as line")
    return once.union(again).selectExpr(
        "cast(line as string) as ligne_source",
        "concat('C', lpad(cast(n as string), 6, '0')) as client_id",
        "'L├⌐a' as prenom",
        "concat('Nom', n) as nom",
        "cast(date_add(date'1950-01-01', cast(n % 15000 as int)) as string) as date_naissance",
        "cast(date_add(date'2021-01-05', cast(n % 1900 as int)) as string) as date_entree",
        f"case when {_between(301, 340)} then 'particulier' else 'Particulier' end as segment",
        f"case when {_between(401, 415)} then 'EMPLOYÉ' else 'Employé' end as profession",
        f"case when {_between(1, 7)} then '-1500.00' else cast(1000 + n % 5000 as string) end as revenu_mensuel",
        "cast(n % 101 as string) as score_risque_initial",
        f"{_a('n % 25 + 1')} as agence_id",
        "'Pau' as ville",
        f"case when {_between(101, 125)} then '' else '64000' end as code_postal",
        f"case when {_between(201, 230)} then '' else concat('C', n, '@banque.fr') end as email",
        "'ACTIF' as statut_client",
    )


def _credits(spark):
    """600 credits: 15 negative rates, 10 unknown branches, 20 types and 25 statuses in another case."""
    return _rows(spark, 1, 600).selectExpr(
        "cast(n as string) as ligne_source",
        "concat('CR', lpad(cast(n as string), 6, '0')) as credit_id",
        "concat('C', lpad(cast(n * 10 as string), 6, '0')) as client_id",
        f"case when {_between(591, 600)} then 'A999' else {_a('n % 25 + 1')} end as agence_id",
        f"case when {_between(21, 40)} then 'PRÊT IMMOBILIER' else 'Prêt immobilier' end as type_credit",
        "cast(date_add(date'2021-02-01', cast(n as int)) as string) as date_octroi",
        "cast(1000 + n as string) as montant_initial",
        f"case when {_between(1, 15)} then '-2.500' else '3.125' end as taux_annuel",
        "'48' as duree_mois",
        "'100.00' as mensualite_theorique",
        "'50' as score_risque_octroi",
        f"case when {_between(41, 65)} then 'en cours' else 'En cours' end as statut_credit",
        "cast(add_months(date_add(date'2021-02-01', cast(n as int)), 48) as string) as date_fin_prevue",
    )


def _targets(spark):
    """25 branches x 42 months from 2023-01 to 2026-06."""
    return _rows(spark, 0, 1049).selectExpr(
        f"{_a('n % 25 + 1')} as agence_id",
        "date_format(add_months(date'2023-01-01', cast(floor(n / 25) as int)), 'yyyy-MM') as mois",
        "cast(10 + n % 100 as string) as objectif_revenu",
        "cast(1 + n % 7 as string) as objectif_nouveaux_clients",
        "cast(10000 + n as string) as objectif_production_credit",
        "'2.50' as seuil_taux_impaye_pct",
    )


def _products(spark):
    return _rows(spark, 1, 10).selectExpr(
        "concat('p', lpad(cast(n as string), 3, '0')) as produit_id",
        "concat('Produit ', n) as nom_produit",
        "case when n = 1 then 'COMPTE' when n <= 3 then 'carte' when n <= 6 then '├ëpargne' "
        "when n <= 9 then 'Cr├⌐dit' else 'Assurance' end as famille_produit",
        "case when n <= 2 then '├ëpargne et flux' when n <= 4 then 'Moyens de paiement' "
        "when n <= 6 then 'Placement' when n <= 9 then 'Financement' else 'Protection' end as univers",
        "cast(1 + n % 4 as string) as niveau_complexite",
    )


def _repayments(spark):
    """18 899 instalments: 20 negative, 103 unpaid, 121 partial, 25 without credit, 283 on credits without branch."""
    late = f"({_between(4001, 11266)} or {_between(15025, 15040)})"
    unpaid = _between(1001, 1103)
    return _rows(spark, 1, 18899).selectExpr(
        "concat('R', lpad(cast(n as string), 8, '0')) as remboursement_id",
        "case when n <= 25 then 'CR999999' when n <= 308 then concat('CR000', 591 + n % 10) "
        "else concat('CR', lpad(cast(1 + n % 590 as string), 6, '0')) end as credit_id",
        "cast(date_add(date'2021-02-14', cast(n % 1900 as int)) as string) as date_echeance",
        f"case when {unpaid} then '' else cast(date_add(date'2021-02-14', cast(n % 1900 + "
        f"case when {late} then 9 else 0 end as int)) as string) end as date_paiement",
        "'100.00' as montant_attendu",
        f"case when {unpaid} then '0.00' when {_between(2001, 2020)} then '-100.00' "
        f"when {_between(3001, 3121)} then '40.00' else '100.00' end as montant_paye",
        f"case when {unpaid} then '94' when {late} then '9' else '0' end as jours_retard",
        f"case when {_between(15001, 15040)} then 'paye a temps' when {unpaid} then 'Impay├⌐' "
        f"when {late} then 'Payé en retard' else 'Payé à temps' end as statut_remboursement",
    )


def _transactions(spark):
    """15 000 operations and 150 repeated lines."""
    once = _rows(spark, 1, 15000).selectExpr("n", "n as line")
    again = _rows(spark, 14001, 14150).selectExpr("n", "n + 100000 as line")
    credit = _between(1001, 4305)
    return once.union(again).selectExpr(
        "cast(line as string) as ligne_source",
        "concat('T', lpad(cast(n as string), 9, '0')) as transaction_id",
        "concat('C', lpad(cast(1 + n % 6000 as string), 6, '0')) as client_id",
        f"case when {_between(201, 240)} then '2026-13-40 10:00:00' else concat(cast(date_add(date'2023-01-01', "
        "cast(n % 1200 as int)) as string), ' 01:20:23') end as date_transaction",
        "case when n <= 782 then 'FRAIS BANCAIRES' when n <= 6559 then 'Paiement carte' "
        "when n <= 9185 then 'Pr├⌐l├¿vement' when n <= 10972 then 'Virement reçu' when n <= 12449 then 'Virement émis' "
        "when n <= 13482 then 'Retrait DAB' when n <= 14392 then 'Remboursement' else 'Dépôt' end as type_transaction",
        f"case when {credit} then '20.00' else '-10.00' end as montant",
        f"case when {_between(1001, 1053)} then 'crédit' when {credit} then 'Crédit' "
        f"when {_between(5001, 5197)} then 'débit' else 'Débit' end as sens",
        f"case when {_between(1, 146)} or {_between(14001, 14004)} then '' else 'P001' end as produit_id",
        f"case when {_between(301, 360)} then 'A999' else {_a('n % 25 + 1')} end as agence_id",
        "'TPE' as canal",
        f"case when {_between(6001, 6150)} then 'validee' when {_between(7001, 7371)} then 'Rejetée' "
        f"when {_between(8001, 8105)} then 'En attente' else 'Validée' end as statut",
        "case when n <= 782 then '1.50' else '0.00' end as frais",
        "'EUR' as devise",
    )
