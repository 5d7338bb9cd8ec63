"""Fixed values of the panel's rules."""

MATCH_MIN, UNCHANGED_MIN, MATCH_MARGIN = 0.25, 0.90, 0.05
REVIEW_BAND = (0.20, 0.40)
HEADING_WEIGHT, BODY_WEIGHT, EDGE_FLOOR = 0.70, 0.30, 0.03
REWRITE_CHURN, REWRITE_LENGTH, REWRITE_COUNT = 0.55, 0.35, 0.25
LABELS = ("NEW", "CARRIED_FORWARD", "MATERIALLY_REVISED", "DROPPED", "AMBIGUOUS")
CATEGORIES = ("financial", "operational", "regulatory", "strategic")
CATEGORY_TEXT = {
    "financial": "Money: credit, funding, rates, securities",
    "operational": "Things breaking: cyber, systems, vendors, people",
    "regulatory": "Rules and courts: laws, supervisors, litigation",
    "strategic": "The plan failing: competition, M&A, reputation",
}
EXCLUDED_CIKS = (1299709, 1518715, 1108134, 101382, 1077428, 36966)
FLAGGED_CIKS = (910073, 764038, 936528)
MIN_HEADING, MIN_BODY, MAX_HEADING, MAX_CATEGORY = 10, 200, 400, 80
MIN_SECTION, MAX_SECTION = 8_000, 500_000
SUMMARY_SHARE, HEADER_REPEATS = 0.35, 3
ASSET_FLOOR, ASSET_CEILING, MAX_COMPANIES = 10_000_000_000, 250_000_000_000, 55
SIC_CODES = ("6020", "6021", "6022", "6035", "6036")
FISCAL_YEARS = (2021, 2022, 2023, 2024, 2025)
BANDS = (0.0, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 1.01)
PERCENTILES = (5, 10, 25, 50, 75, 90, 95, 99)
#: Themes of the warehouse's control query.
THEMES = {
    "deposits": "uninsured|deposit concentration|bank failure|fdic insurance",
    "cyber": "cyber|information security|data breach|ransomware",
    "ai": "artificial intelligence|machine learning|generative",
    "climate": "climate|weather|natural disaster",
    "rates": "interest rate|net interest|unrealized loss",
}
#: Themes of the signal report.
PRESETS = {
    "deposits": "uninsured|deposit concentration|deposit outflow|bank failure|liquidity risk|depositor confidence|run on|withdraw",
    "cyber": "cyber|information security|data breach|ransomware|unauthorized (access|occurrence)",
    "ai": r"artificial intelligence|\bAI\b|machine learning|generative",
    "climate": "climate|weather|natural disaster|environmental",
    "rates": "interest rate|net interest|yield curve|unrealized loss|held.to.maturity|securities portfolio",
    "crypto": "crypto|digital asset|stablecoin|blockchain",
    "cre": r"commercial real estate|\bCRE\b|office (property|building|space)",
}
#: Themes of the dashboard.
SIGNALS = {
    "Deposits / liquidity": "uninsured|deposit concentration|deposit outflow|bank failure|liquidity risk|depositor confidence",
    "Cybersecurity": "cyber|information security|data breach|ransomware",
    "Artificial intelligence": r"artificial intelligence|\bAI\b|machine learning|generative",
    "Interest rates": "interest rate|net interest|unrealized loss|securities portfolio",
    "Climate": "climate|weather|natural disaster",
    "Commercial real estate": r"commercial real estate|\bCRE\b|office",
}
KEYWORD_WEIGHTS = (3, 1)
TIE_CATEGORY = "financial"
#: Terms of the keyword classifier, each found at the beginning of a word.
KEYWORDS = {
    "financial": [
        "loan", "loans", "lending", "borrower", "credit risk", "credit loss", "default", "delinquen", "charge-off", "charge off",
        "nonperforming", "non-performing", "allowance for credit", "allowance for loan", "collateral", "underwriting", "cecl",
        "provision for credit", "asset quality", "foreclosure", "loan portfolio", "concentration", "liquidity", "funding", "deposit",
        "deposits", "wholesale funding", "borrowings", "capital markets", "cash flow", "dividend", "interest rate", "net interest",
        "yield curve", "securities", "investment portfolio", "fair value", "impairment", "valuation", "libor", "sofr", "benchmark rate",
        "trading", "mortgage banking", "economic conditions", "economy", "recession", "inflation", "climate change", "market conditions",
    ],
    "operational": [
        "cyber", "cybersecurity", "information security", "data breach", "breach", "hacking", "malware", "ransomware", "phishing",
        "information technology", "systems", "system failure", "outage", "business continuity", "disaster recovery", "third-party",
        "third party", "vendor", "service provider", "outsourc", "fraud", "theft", "employee", "personnel", "talent", "key employees",
        "human capital", "internal control", "operational risk", "model risk", "models", "data privacy", "artificial intelligence",
        "technology systems",
    ],
    "regulatory": [
        "regulat", "supervis", "examination", "compliance", "statute", "legislation", "legislative", "law", "laws", "rulemaking",
        "litigation", "legal proceeding", "lawsuit", "enforcement", "penalt", "fine", "sanction", "consent order", "cease and desist",
        "dodd-frank", "basel", "capital requirement", "capital adequacy", "stress test", "ccar", "cfpb", "fdic", "occ", "federal reserve",
        "sec ", "anti-money laundering", "money laundering", "bank secrecy", "community reinvestment", "tax law", "accounting standard",
        "government", "governmental",
    ],
    "strategic": [
        "compet", "competition", "competitor", "market share", "acquisition", "acquire", "merger", "integration", "divestiture",
        "strategy", "strategic", "business strategy", "growth", "expansion", "new products", "new lines of business", "innovat",
        "disrupt", "fintech", "digital", "branch network", "reputation", "reputational", "brand", "public perception",
        "environmental, social", "esg", "stakeholder",
    ],
}
