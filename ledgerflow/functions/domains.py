"""Closed label domains of the bank and the mapping to their canonical form.

Everything in this module is a fixed value: the labels decide the results
and must be spelled exactly like this.
"""

from __future__ import annotations

# --- fixed values: canonical labels per column -----------------------------
CATEGORIE_AGENCE = ("Urbaine", "Périurbaine", "Rurale")
SEGMENT = ("Particulier", "Professionnel", "Association")
PROFESSION = (
    "Agriculteur",
    "Artisan",
    "Cadre",
    "Commerçant",
    "Employé",
    "Enseignant",
    "Profession libérale",
    "Retraité",
    "Sans emploi",
    "Technicien",
    "Étudiant",
)
STATUT_CLIENT = ("Actif", "Inactif", "Clos")
TYPE_CREDIT = ("Prêt immobilier", "Prêt personnel", "Prêt automobile")
STATUT_CREDIT = ("En cours", "Terminé")
FAMILLE_PRODUIT = ("Compte", "Carte", "Épargne", "Crédit", "Assurance")
UNIVERS = (
    "Épargne et flux",
    "Moyens de paiement",
    "Placement",
    "Financement",
    "Protection",
)
STATUT_REMBOURSEMENT = ("Payé à temps", "Payé en retard", "Impayé")
TYPE_TRANSACTION = (
    "Paiement carte",
    "Prélèvement",
    "Virement reçu",
    "Virement émis",
    "Retrait DAB",
    "Remboursement",
    "Frais bancaires",
    "Dépôt",
)
SENS = ("Débit", "Crédit")
CANAL = ("Application mobile", "TPE", "Web", "DAB", "Agence")
STATUT_TRANSACTION = ("Validée", "Rejetée", "En attente")
DEVISE = ("EUR",)

# --- fixed values: accepted spellings without accents ----------------------
UNACCENTED_SENS = {"DEBIT": "Débit", "CREDIT": "Crédit"}
UNACCENTED_STATUT_TRANSACTION = {"VALIDEE": "Validée", "REJETEE": "Rejetée"}
UNACCENTED_STATUT_REMBOURSEMENT = {"PAYE A TEMPS": "Payé à temps"}

# --- fixed values: text damaged by a wrong code page -> repaired text -------
MOJIBAKE = (
    ("├⌐", "é"),
    ("├¿", "è"),
    ("├º", "ç"),
    ("├ç", "Ç"),
    ("├ë", "É"),
    ("├è", "Ê"),
    ("├á", "à"),
    ("├¬", "ê"),
    ("├┤", "ô"),
)
# Lead character shared by every damaged pair above.
MOJIBAKE_LEAD = "├"
# Characters whose presence after cleaning betrays remaining damage.
MOJIBAKE_TRACES = ("├", "√", "Ã")

# --- fixed values: French calendar names ------------------------------------
JOURS = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")
MOIS = (
    "Janvier",
    "Février",
    "Mars",
    "Avril",
    "Mai",
    "Juin",
    "Juillet",
    "Août",
    "Septembre",
    "Octobre",
    "Novembre",
    "Décembre",
)


def spelling_map(labels: tuple[str, ...], extra: dict[str, str] | None = None) -> dict[str, str]:
    """Upper-cased spelling -> canonical label."""
    return {label.upper(): label for label in labels} | (extra or {})
