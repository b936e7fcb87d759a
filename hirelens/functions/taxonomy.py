"""Configuration data for the posting classifiers and lexicon marts.

Every operator takes its rules as a parameter; these are the defaults that
reproduce the posting pipeline. Order matters in every rule list: the first
matching rule wins.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the posting pipeline's configuration for the
# results to match. Stated in natural order, as plain text.
# ---------------------------------------------------------------------------

# Work type from the description (regex, label); default FULL_TIME.
WORK_TYPE_RULES = [
    ("contract|contractor|freelance|1099|corp.to.corp|c2c", "CONTRACT"),
    ("part[ -]time", "PART_TIME"),
]
# The board feed's variant lacks corp-to-corp.
WORK_TYPE_RULES_PORTAL = [
    ("contract|contractor|freelance|1099|c2c", "CONTRACT"),
    ("part[ -]time", "PART_TIME"),
]
WORK_TYPE_DEFAULT = "FULL_TIME"

# Remote flag from free text (feed 1): regex → value.
REMOTE_TEXT_RULES = [
    ("fully remote|100% remote|work from home|wfh|remote.first|remote only", "1"),
    ("hybrid", "hybrid"),
]

# Experience level from the (raw, untrimmed) title; default MI.
EXPERIENCE_RULES = [
    ("vp |vice president|director|head of|chief", "EX"),
    ("staff |principal |lead ", "DI"),
    (r"senior|sr\.? |sr-", "SE"),
    (r"junior|jr\.? |jr-|entry.level|associate", "EN"),
]
EXPERIENCE_DEFAULT = "MI"

# Seniority label and sort order per experience code.
SENIORITY_LABELS = {"EN": "Entry Level", "MI": "Mid Level", "SE": "Senior",
                    "EX": "Staff/Lead", "DI": "Principal"}
SENIORITY_ORDER = {"EN": 1, "MI": 2, "SE": 3, "EX": 4, "DI": 5}

# Role clusters: (list of title substrings, label); variants per mart.
ROLES_TRENDS = [
    (["data engineer"], "Data Engineer"),
    (["data scientist"], "Data Scientist"),
    (["data analyst"], "Data Analyst"),
    (["machine learning"], "ML Engineer"),
    (["ai engineer"], "AI Engineer"),
    (["software engineer"], "Software Engineer"),
]
ROLES_LOCATION = [
    (["data engineer"], "Data Engineer"),
    (["data scientist"], "Data Scientist"),
    (["data analyst"], "Data Analyst"),
    (["machine learning"], "ML Engineer"),
    (["ai engineer", "llm"], "AI/LLM Engineer"),
    (["software engineer"], "Software Engineer"),
    (["analytics engineer"], "Analytics Engineer"),
]
ROLES_SALARY = [
    (["data engineer"], "Data Engineer"),
    (["data scientist"], "Data Scientist"),
    (["data analyst"], "Data Analyst"),
    (["machine learning"], "ML Engineer"),
    (["ai engineer"], "AI Engineer"),
    (["software engineer"], "Software Engineer"),
    (["backend"], "Backend Engineer"),
    (["frontend"], "Frontend Engineer"),
    (["fullstack", "full stack"], "Full Stack Engineer"),
    (["product manager"], "Product Manager"),
    (["devops", "platform engineer"], "DevOps/Platform"),
]
ROLES_SENIORITY = [
    (["data engineer"], "Data Engineer"),
    (["data scientist"], "Data Scientist"),
    (["data analyst"], "Data Analyst"),
    (["machine learning"], "ML Engineer"),
    (["ai engineer", "llm"], "AI/LLM Engineer"),
    (["analytics engineer"], "Analytics Engineer"),
    (["bi ", "business intelligence"], "BI Developer"),
]
ROLES_SKILLS = ROLES_LOCATION

# Location pivot columns: (role label, output column).
LOCATION_PIVOTS = [
    ("Data Engineer", "de_count"),
    ("Data Scientist", "ds_count"),
    ("Data Analyst", "da_count"),
    ("Software Engineer", "swe_count"),
    ("ML Engineer", "ml_count"),
]

# Company tiers: (label, regex over the lower-cased name), then a fallback.
COMPANY_TIERS = [
    ("FAANG+", "google|meta|facebook|amazon|apple|netflix|microsoft|openai|anthropic|deepmind|nvidia|bytedance|tiktok"),
    ("Scale-up", "stripe|databricks|snowflake|airbnb|doordash|instacart|figma|notion|linear|vercel|hugging face|cohere|mistral|scale ai|anyscale|weights.*biases|confluent|dbt labs|fivetran|airbyte|airtable|asana|canva|miro|retool"),
    ("Enterprise", "oracle|sap|ibm|salesforce|servicenow|workday|dell|hp|intel|cisco|vmware|adobe|autodesk|intuit|paypal|ebay|twitter|x corp|linkedin|uber|lyft|robinhood|coinbase|palantir|datadog|splunk|elastic|mongodb|cloudflare|okta|zendesk|twilio|sendgrid|box|dropbox|hubspot|atlassian|gitlab|github"),
]
TIER_FALLBACK = "Startup / Other"
TIER_UNKNOWN = "Unknown"

# Topic gate for the co-occurrence mart.
TOPIC_TEXT_REGEX = ("large language model|llm|generative ai|gen.?ai|gpt|llama|claude|gemini|vector database|"
                    "rag |retrieval.augmented|embedding model|foundation model|transformer model")
TOPIC_TITLE_REGEX = "ai engineer|llm engineer|ml engineer|machine learning engineer|genai|gen ai"

# Lexicons (the demand lexicon lists airflow twice; de-duplicated on use).
LEXICON_DEMAND = [
    "python", "sql", "spark", "aws", "azure", "gcp", "kafka", "airflow", "dbt",
    "snowflake", "tableau", "power bi", "docker", "kubernetes", "tensorflow",
    "pytorch", "scikit-learn", "pandas", "numpy", "excel", "looker", "databricks",
    "java", "scala", "r studio", "git", "hadoop", "hive", "redshift", "bigquery",
    "mongodb", "postgresql", "mysql", "javascript", "typescript", "fastapi",
    "flask", "langchain", "llm", "pinecone", "mlflow", "terraform", "linux",
    "pyspark", "streamlit", "plotly", "dask", "celery", "redis", "elasticsearch",
    "github actions", "airflow", "dagster", "prefect",
]
LEXICON_BY_ROLE = [
    "python", "sql", "spark", "aws", "azure", "gcp", "kafka", "airflow", "dbt",
    "snowflake", "tableau", "power bi", "docker", "kubernetes", "tensorflow",
    "pytorch", "scikit-learn", "pandas", "numpy", "excel", "looker", "databricks",
    "java", "scala", "r studio", "git", "hadoop", "hive", "redshift", "bigquery",
    "mongodb", "postgresql", "mysql", "javascript", "typescript", "fastapi",
    "flask", "langchain", "llm", "pinecone", "mlflow", "terraform", "linux",
    "pyspark", "streamlit", "plotly", "dask", "redis", "elasticsearch",
    "github actions", "dagster", "prefect",
]
LEXICON_TOPIC = [
    "python", "sql", "spark", "aws", "azure", "gcp", "kafka", "airflow", "dbt",
    "snowflake", "tableau", "power bi", "docker", "kubernetes", "tensorflow",
    "pytorch", "scikit-learn", "pandas", "numpy", "excel", "looker", "databricks",
    "java", "scala", "git", "hadoop", "hive", "redshift", "bigquery",
    "mongodb", "postgresql", "mysql", "javascript", "typescript", "fastapi",
    "flask", "langchain", "pinecone", "mlflow", "terraform", "linux",
    "pyspark", "streamlit", "plotly", "dask", "redis", "elasticsearch",
    "github actions", "dagster", "prefect", "hugging face", "ray", "triton",
]

# Title include / exclude substrings (exclude wins).
TITLE_INCLUDE = [
    "data analyst", "analytics analyst", "business analyst", "bi analyst",
    "business intelligence", "reporting analyst", "operations analyst",
    "product analyst", "healthcare data", "clinical data", "health informatics",
    "clinical informatics", "population health", "quality analyst",
    "data engineer", "analytics engineer", "etl", "data scientist",
    "applied scientist", "quantitative analyst",
]
TITLE_EXCLUDE = [
    "senior", "staff", "principal", "lead", "director", "vp", "head of",
    "manager", "research scientist", "ml researcher", "machine learning engineer",
    "deep learning", "computer vision", "nlp researcher",
    "ios", "android", "blockchain", "web3",
]

# Title separators, tested in this order.
TITLE_SEPARATORS = [" | ", " - ", " – ", " — ", " at ", " @ "]

# US state names → postal codes (50 states and DC).
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR",
    "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID",
    "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK",
    "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT",
    "Vermont": "VT", "Virginia": "VA", "Washington": "WA", "West Virginia": "WV",
    "Wisconsin": "WI", "Wyoming": "WY", "District of Columbia": "DC",
}

# Pay-period factors: SQL archive path and the aggregator feed.
PAY_FACTORS_ARCHIVE = {"HOURLY": 2080, "MONTHLY": 12}
PAY_FACTORS_FEED = {"HOUR": 2080, "WEEK": 52, "WEEKLY": 52, "MONTH": 12, "MONTHLY": 12}

# Match-score bands (score ≥ threshold → label), highest first.
MATCH_BANDS = [(0.7, "strong"), (0.5, "moderate")]
MATCH_BAND_DEFAULT = "weak"

# Fallback board list when no target file is available: (company, kind, slug).
FALLBACK_TARGETS = [
    ("Airbnb", "greenhouse", "airbnb"),
    ("DoorDash", "greenhouse", "doordashusa"),
    ("Stripe", "greenhouse", "stripe"),
    ("Lyft", "greenhouse", "lyft"),
    ("Databricks", "greenhouse", "databricks"),
    ("Figma", "greenhouse", "figma"),
    ("Notion", "greenhouse", "notion"),
    ("Plaid", "greenhouse", "plaid"),
    ("Chime", "greenhouse", "chime"),
    ("Ramp", "ashby", "ramp"),
    ("Brex", "ashby", "brex"),
]

# Archive load manifest: landed file → raw table name.
ARCHIVE_MANIFEST = {
    "postings.csv": "JOB_POSTINGS",
    "jobs/job_skills.csv": "JOB_SKILLS",
    "companies/companies.csv": "COMPANIES",
    "jobs/salaries.csv": "JOB_SALARIES",
    "jobs/job_industries.csv": "JOB_INDUSTRIES",
}

# Declared column checks: (table, column, check).
DECLARED_CHECKS = [
    ("stg_job_postings", "job_id", "not_null"),
    ("stg_job_postings", "job_id", "unique"),
    ("stg_job_postings", "company_name", "not_null"),
    ("stg_job_postings", "job_title", "not_null"),
    ("stg_job_skills", "job_id", "not_null"),
    ("stg_job_skills", "skill_id", "not_null"),
    ("stg_companies", "company_id", "not_null"),
    ("stg_companies", "company_id", "unique"),
    ("mart_skill_demand", "skill_id", "not_null"),
    ("mart_skill_demand", "skill_id", "unique"),
    ("mart_skill_demand", "job_count", "not_null"),
    ("mart_salary_by_role", "role_cluster", "not_null"),
    ("mart_salary_by_role", "role_cluster", "unique"),
]

# FIXED VALUES: the query label of board postings, and the blocks of a target list (name, API address).
BOARD_QUERY = "portal_scan"
TARGET_PATTERN = r"(?s)- name: (.+?)\n.*?api: (https://[^\n]+)"
