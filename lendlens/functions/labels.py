"""Label strings and display constants.

Every string here is data that must equal the application's output exactly
(accents, spacing and ``<``/``>`` included), so they are kept together and
untouched. The source file is UTF-8.
"""

from __future__ import annotations

# --- Fixed values: cohort band labels ---------------------------------------
# (upper bound, label); a value below the bound takes the label; the last
# label catches everything else, null included.
AGE_BANDS = ((25, "< 25 ans"), (35, "25-35 ans"), (45, "35-45 ans"), (55, "45-55 ans"))
AGE_OTHER = "> 55 ans"

EMPLOYMENT_BANDS = ((1, "< 1 an"), (3, "1-3 ans"), (5, "3-5 ans"), (10, "5-10 ans"))
EMPLOYMENT_OTHER = "> 10 ans"

# Enquiry bands: first an equality test, then inclusive upper bounds.
ENQUIRY_NONE = "Aucune demande"
ENQUIRY_BANDS = ((2, "1-2 demandes"), (5, "3-5 demandes"), (10, "6-10 demandes"))
ENQUIRY_OTHER = "> 10 demandes"

REALTY_LABELS = {"Y": "Propriétaire", "N": "Non propriétaire"}

WEEKDAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")

# Value used for absent categorical values during feature preparation.
UNKNOWN = "Unknown"

# Sentinel day count meaning "not employed".
UNEMPLOYED_DAYS = 365243

# --- Fixed values: chart titles per analysis --------------------------------
TITLES = {
    1: "Taux de défaut par groupe age",
    2: "Relation entre ratio crédit/revenu et taux de défaut",
    3: "Type de revenu, montant et taux de défaut",
    4: "Impact ancienneté emploi sur le taux de défaut",
    5: "Impact des demandes de crédit sur le taux de défaut",
    6: "Taux de défaut par type de contrat et propriété immobilière",
    7: "Taux de défaut selon le statut familial et le nombre enfants",
    8: "Variation du taux de défaut selon le jour de la semaine",
}

# --- Fixed values: risk levels and recommendations --------------------------
# (minimum score, level); scores below the last bound are "Faible".
RISK_LEVEL_BOUNDS = ((0.70, "Élevé"), (0.40, "Moyen"))
RISK_LEVEL_OTHER = "Faible"

RECOMMENDATIONS = (
    {
        "risk_level": "Élevé",
        "decision": "Refus recommandé",
        "explanation": "Le niveau de risque est trop élevé pour accorder le crédit aux conditions demandées.",
        "alternative": "Proposer un montant réduit avec garanties supplémentaires.",
        "action_plan": (
            "Refuser le crédit aux conditions demandées",
            "Proposer un montant réduit (max 30% du revenu)",
            "Exiger des garanties supplémentaires (caution, hypothèque)",
            "Orienter le client vers un accompagnement budgétaire",
        ),
    },
    {
        "risk_level": "Moyen",
        "decision": "Acceptation conditionnelle",
        "explanation": "Le dossier présente un risque modéré qui nécessite des garanties supplémentaires.",
        "alternative": "Envisager un co-emprunteur ou une caution solidaire.",
        "action_plan": (
            "Accepter sous réserve de garanties supplémentaires",
            "Ajuster le taux d'intérêt pour compenser le risque",
            "Proposer une durée d'emprunt plus courte",
            "Mettre en place un suivi trimestriel",
        ),
    },
    {
        "risk_level": "Faible",
        "decision": "Acceptation recommandée",
        "explanation": "Le profil présente un faible risque de défaut.",
        "alternative": "Procéder à l'octroi du crédit aux conditions standards.",
        "action_plan": (
            "Accorder le crédit aux conditions standards",
            "Proposer des produits complémentaires (assurance, épargne)",
            "Appliquer le processus de suivi standard",
            "Réévaluer le risque annuellement",
        ),
    },
)

# --- Fixed values: display translations of report fields -------------------
TRANSLATIONS = {
    "gender": {"M": "Homme", "F": "Femme"},
    "income_type": {
        "Working": "Salarié",
        "Commercial associate": "Commercial",
        "Pensioner": "Retraité",
        "State servant": "Fonctionnaire",
        "Entrepreneur": "Entrepreneur",
    },
    "education_type": {
        "Higher education": "Enseignement supérieur",
        "Secondary / secondary special": "Secondaire",
        "Incomplete higher": "Supérieur incomplet",
        "Lower secondary": "Premier cycle secondaire",
        "Academic degree": "Diplôme universitaire",
    },
    "family_status": {
        "Married": "Marié(e)",
        "Single / not married": "Célibataire",
        "Civil marriage": "Pacs",
        "Separated": "Séparé(e)",
        "Widow": "Veuf/veuve",
    },
    "housing_type": {
        "House / apartment": "Maison / appartement",
        "Rented apartment": "Location",
        "With parents": "Chez les parents",
        "Municipal apartment": "Logement social",
        "Office apartment": "Logement de fonction",
        "Co-op apartment": "Coopérative",
    },
}

# --- Fixed values: run stamp -------------------------------------------------
STAMP = {
    "version": "1.2.3",
    "model_type": "Régression logistique",
    "data_source": "Historique clients 2020-2024",
}
DATE_FORMAT = "dd/MM/yyyy"
TIME_FORMAT = "HH:mm"

# --- Fixed values: answer for an id that is not in the portfolio ------------
CLIENT_NOT_FOUND = "Client ID %d non trouvé dans les données"

# --- Fixed values: feedback defaults and levels -----------------------------
FEEDBACK_EMPTY_MESSAGE = "Message vide"
FEEDBACK_LEVEL_POSITIVE = "INFO"
FEEDBACK_LEVEL_NEGATIVE = "ERROR"
