"""Fixed values that results depend on: they must equal the published rules of the page and document cleaners."""

# Tags, and parts of class or id, that make an element boilerplate of a page.
NOISE_TAGS = [
    "script", "style", "noscript", "iframe",
    "nav", "footer", "header", "aside",
    "form", "button", "svg", "figure",
    "cookie-banner", "cookie-notice",
]
NOISE_PATTERNS = [
    "cookie", "banner", "popup", "modal",
    "sidebar", "breadcrumb", "share",
    "social", "newsletter", "subscribe",
    "advertisement", "advert", "skip-link",
    "site-header", "site-footer", "top-nav",
    "related-links", "related-content",
    "in-this-section", "in_this_section",
    "section-nav", "local-nav", "local-links",
    "page-nav", "secondary-nav", "sub-nav",
    "utility-links", "share-links", "share-page",
    "social-share", "addthis", "sharethis",
    "pagination", "pager", "tag-list",
    "was-this-page", "feedback-form",
    "follow-us", "footer-links",
]
SOCIAL_WORDS = ["facebook", "twitter", "whatsapp", "messenger", "linkedin", "share"]

# The same for pages that a resource links to.
LINKED_NOISE_TAGS = ["nav", "header", "footer", "aside", "script", "style", "noscript", "form", "iframe", "button", "figure"]
LINKED_NOISE_PATTERN = "(nav|menu|header|footer|sidebar|cookie|banner|ad[sv]?|popup|modal|breadcrumb|social|share|comment|related|pagination|widget)"

# Elements that hold text, and names of the division that holds the content.
CONTENT_TAGS = ["p", "li", "td", "th", "dd", "dt", "blockquote", "figcaption"]
CONTENT_HINTS = ["content", "main-content", "page-content", "entry-content", "post-content", "body-content"]

# Section names that are headings without number or capitals.
KNOWN_SECTIONS = [
    "introduction", "background", "methodology", "methods", "results",
    "discussion", "conclusion", "conclusions", "recommendations",
    "references", "acknowledgements", "acknowledgments", "abstract",
    "summary", "overview", "appendix", "findings", "analysis",
    "interventions", "testimonials", "limitations", "implications",
    "preface", "glossary", "key findings", "the broader picture",
    "findings in-depth", "connect with us", "about you",
    "a communications toolkit",
]

# Section names that count as headings wherever they stand. The last of the published list, a
# publisher's own "about" section, is for the caller to add.
UNIVERSAL_SECTIONS = [
    "abstract", "foreword", "preface", "introduction", "background",
    "methodology", "methods", "results", "discussion", "conclusion",
    "conclusions", "references", "acknowledgements", "acknowledgments",
    "recommendations", "summary", "overview", "appendix", "limitations",
    "implications", "interventions", "testimonials", "key findings",
    "findings in-depth", "connect with us", "contents", "table of contents", "scope",
    "about this report",
]
