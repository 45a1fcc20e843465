"""The tag taxonomy and the word lists of the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The controlled vocabulary and word lists that results are checked against.
TAXONOMY = {
    "resource_type": [
        "Academic Paper", "Blog Post", "Book Chapter", "Case Study/Testimonial", "EDI Intervention", "Evidence Document",
        "Guidance", "Legislation", "People Profile", "Policy Document", "Presentation or Poster", "Report or Article",
        "Resource Database", "Training Material",
    ],
    "resource_format": ["Database", "Dataset", "Document", "Mixed format", "Podcast", "Video", "Webinar", "Webpage"],
    "individual_characteristics": [
        "Age", "Career Stage", "Caring Responsibilities", "Disability", "Education Status", "Gender", "Intersectionality",
        "Job Roles", "Linguistic", "Marriage and Civil Partnership", "Nationality", "Neurodiversity",
        "Physical Characteristics", "Pregnancy and Maternity", "Race and Ethnicity", "Religion and Belief", "Sex",
        "Sexual Orientation", "Socio-Economic Disadvantage", "Temporary Impairment", "Trans Identity", "Not Specified",
    ],
    "career_pathway": [
        "Career Mobility", "Career Progression", "Early Career", "Leadership", "Mentoring", "Mid-career",
        "Networking and Collaboration", "Recruitment", "Retention", "Visibility and Recognition",
    ],
    "organisational_culture": [
        "Accessibility", "Allyship and Advocacy", "Belonging and Engagement", "Bias", "Cultural Competency",
        "Data Collection and Monitoring", "Harassment Bullying and Microaggression", "Inclusive Leadership", "Inclusivity",
        "Representation", "Research Culture", "Research Design", "Strategy or Policy", "Work-Life Balance",
    ],
    "research_funding_process": [
        "Advertising", "Application Process", "Assessment Process", "Bias Mitigation", "Data Collection and Monitoring",
        "Eligibility Criteria", "Funding Guidance", "Pre and Post Award Support", "University Selection",
    ],
    "adoption_readiness_level": [
        "Initial Design", "Needs Identification", "Not applicable", "Pilot in Single Setting", "Proof of Concept",
        "Scaling in Multiple Settings", "Widespread Adoption",
    ],
}
SINGLE = ("resource_type", "resource_format", "adoption_readiness_level")
MULTI = tuple(d for d in TAXONOMY if d not in SINGLE)
#: The batch tagger's older version has no "Not Specified" among the characteristics.
BATCH_TAXONOMY = TAXONOMY | {"individual_characteristics": TAXONOMY["individual_characteristics"][:-1]}
SECTORS = ["Academia", "Government", "Industry", "International", "Learned society", "Not-for-profit", "Other", "Not Specified"]
TYPOS = {
    "caring responsiblities": "Caring Responsibilities",
    "netwotking and collaboration": "Networking and Collaboration",
    "harassment, bullying and microagression": "Harassment Bullying and Microaggression",
    "harassment bullying and microagression": "Harassment Bullying and Microaggression",
}
FUNDING_KEYWORDS = [
    "grant application", "grant proposal", "funding application", "funding call", "funding scheme", "funding round",
    "research grant", "grant award", "award process", "eligibility criteria", "peer review panel", "assessment panel",
    "funding guidance", "pre-award", "post-award", "application process", "funding process", "proposal submission",
]
IMPLEMENTATION_KEYWORDS = [
    "piloted", "pilot study", "rolled out", "implemented at", "scaling across", "participating institution",
    "programme delivered", "cohort", "participants completed", "has been adopted", "widespread adoption",
    "multiple settings", "multiple organisations",
]
NOT_APPLICABLE_TYPES = ["Academic Paper", "Evidence Document", "Guidance", "Legislation", "Policy Document"]
#: Types for which implementation keywords decide.
KEYWORD_TYPES = ["Report or Article", "Resource Database"]
GENERIC_PHRASES = [
    "underrepresented groups", "diverse groups", "diverse candidates", "all potential employees", "broader community",
    "specific groups", "targeted communities", "marginalised groups", "all individuals", "various groups",
]
#: Headings of the summary template of each resource type.
TEMPLATES = {
    "Guidance": ["Outline", "Implementation", "Application", "Expected outcomes"],
    "EDI Intervention": ["Outline", "Implementation", "Evaluation", "Outcomes"],
    "Academic Paper": ["Outline", "Methodology", "Findings", "Implications"],
    "Blog Post": ["Outline", "Key points", "Relevance"],
    "Book Chapter": ["Outline", "Key arguments", "Contribution"],
    "Case Study/Testimonial": ["Outline", "Context", "What happened", "Outcomes and lessons"],
    "Evidence Document": ["Outline", "Evidence base", "Key findings", "Recommendations"],
    "Legislation": ["Outline", "Scope and applicability", "Requirements", "Compliance and enforcement"],
    "People Profile": ["Outline", "Background and career", "EDI contribution", "Key messages"],
    "Policy Document": ["Outline", "Scope", "Requirements and commitments", "Implementation"],
    "Presentation or Poster": ["Outline", "Key messages", "Audience and purpose"],
    "Report or Article": ["Outline", "Scope and methods", "Key findings", "Recommendations"],
    "Resource Database": ["Outline", "Scope and content", "Access and usability", "Maintenance"],
    "Training Material": ["Outline", "Content and structure", "Delivery requirements", "Expected outcomes"],
}
GENERIC_TEMPLATE = ["Outline", "Key points", "Relevance"]
DEFAULT_TYPE = "Report or Article"


def taxonomy_frame(spark: SparkSession, taxonomy: dict[str, list[str]] = TAXONOMY) -> DataFrame:
    """``dim, pos, tag, tag_lower, tag_norm, is_multi``: 84 fixed rows, small enough to broadcast by size."""
    rows = [
        (dim, pos, tag, tag.lower(), tag.replace("-", " ").replace("_", " ").lower().strip(), dim not in SINGLE)
        for dim, tags in taxonomy.items()
        for pos, tag in enumerate(tags)
    ]
    return spark.createDataFrame(rows, "dim string, pos int, tag string, tag_lower string, tag_norm string, is_multi boolean")


def template_frame(spark: SparkSession) -> DataFrame:
    """``resource_type, pos, heading``; the generic template under the null type."""
    rows = [(t, i, h) for t, hs in TEMPLATES.items() for i, h in enumerate(hs)] + [(None, i, h) for i, h in enumerate(GENERIC_TEMPLATE)]
    return spark.createDataFrame(rows, "resource_type string, pos int, heading string")


def values(rows: list[tuple]) -> str:
    """Rows as the inside of an SQL VALUES list."""
    quote = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)
