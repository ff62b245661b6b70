"""Preference profiles.

A profile is a driver-side dict in the shape of the reference's YAML file.  It is
configuration, not data: its term lists are bounded by what a user types, so
they enter plans as literals (folded by Catalyst), never as broadcast tables.
"""

from __future__ import annotations

# The reference's shipped preference profile.
SHIPPED_PROFILE = {
    "job_types": ["java developer", "backend", "software engineer"],
    "skills": {
        "must_have": ["java", "spring", "api"],
        "nice_to_have": ["docker", "aws", "typescript", "nextjs"],
    },
    "locations": {
        "remote": True,
        "countries": ["Finland", "Sweden", "Norway", "Denmark", "Estonia"],
        "exclude_regions": [],
    },
    "experience_level": ["mid", "senior"],
    "min_salary": 60000,
    "keywords": ["remote", "backend", "java", "spring", "spring boot", "hibernate"],
    "excluded_terms": ["wordpress", "php", "junior"],
    "company_types": ["startup", "tech", "established"],
    "scoring": {
        "skill_match_weight": 0.4,
        "location_weight": 0.2,
        "salary_weight": 0.2,
        "company_weight": 0.1,
        "job_description_weight": 0.1,
    },
    "notification": {"min_score": 0.5, "daily_limit": 5},
}

# Default scoring weights when a profile gives none.
DEFAULT_WEIGHTS = {
    "skill_match_weight": 0.4,
    "location_weight": 0.2,
    "salary_weight": 0.2,
    "company_weight": 0.1,
    "job_description_weight": 0.1,
}

# Company-name heuristics of the full matcher (substring tests).
COMPANY_TYPE_TERMS = {
    "startup": ["startup", "labs", "technologies", "tech"],
    "tech": ["tech", "digital", "software", "solutions", "systems"],
    "established": ["inc", "corp", "ltd", "limited", "group"],
}

# Validation rules of the cleaning step.
VALID_SOURCES = ["linkedin", "upwork", "indeed"]
SPAM_PHRASES = ["test job", "sample job", "fake job", "placeholder", "[job description]"]
REMOTE_TERMS = ["remote", "work from home", "wfh", "virtual"]
MIN_TITLE_CHARS = 10

# The English stop words of the matcher's text vectoriser (the published
# list of the usual Python tf-idf vectoriser), removed before 1- and 2-grams are formed.
STOP_WORDS = tuple("""
a about above across after afterwards again against all almost alone along already also although always am
among amongst amoungst amount an and another any anyhow anyone anything anyway anywhere are around as at
back be became because become becomes becoming been before beforehand behind being below beside besides
between beyond bill both bottom but by call can cannot cant co con could couldnt cry de describe detail do
done down due during each eg eight either eleven else elsewhere empty enough etc even ever every everyone
everything everywhere except few fifteen fifty fill find fire first five for former formerly forty found
four from front full further get give go had has hasnt have he hence her here hereafter hereby herein
hereupon hers herself him himself his how however hundred i ie if in inc indeed interest into is it its
itself keep last latter latterly least less ltd made many may me meanwhile might mill mine more moreover
most mostly move much must my myself name namely neither never nevertheless next nine no nobody none noone
nor not nothing now nowhere of off often on once one only onto or other others otherwise our ours ourselves
out over own part per perhaps please put rather re same see seem seemed seeming seems serious several she
should show side since sincere six sixty so some somehow someone something sometime sometimes somewhere
still such system take ten than that the their them themselves then thence there thereafter thereby
therefore therein thereupon these they thick thin third this those though three through throughout thru
thus to together too top toward towards twelve twenty two un under until up upon us very via was we well
were what whatever when whence whenever where whereafter whereas whereby wherein whereupon wherever whether
which while whither who whoever whole whom whose why will with within without would yet you your yours
yourself yourselves
""".split())


def get(profile: dict, *path, default=None):
    cur = profile or {}
    for p in path:
        if not isinstance(cur, dict) or p not in cur:
            return default
        cur = cur[p]
    return default if cur is None else cur


def weights(profile: dict) -> dict:
    w = dict(DEFAULT_WEIGHTS)
    w.update({k: v for k, v in (get(profile, "scoring", default={}) or {}).items() if k in w})
    return w

