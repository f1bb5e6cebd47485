"""Five sites as documents, and what the analyses make of them.

Fixed values: the published figures of the sites for October to December 2022.
"""

import json

MONTHS = ("2022-10-01", "2022-11-01", "2022-12-01")

# domain: (global rank, visits, bounce, pages, duration, visits by month, rank by month)
SITES = {
    "pitchbook.com": (
        18054, 2474684, "36.03%", 7.516650574628902, "00:04:08",
        (2840358, 2974914, 2474684), (15181, 14675, 18054),
    ),
    "stripe.com": (
        1062, 46952509, "53.17%", 4.0038311378093585, "00:03:44",
        (43224435, 45589745, 46952509), (1131, 1080, 1062),
    ),
    "byte-trading.com": (
        7277936, 0, "", 0.0, "", (None, None, None), (5467516, 9628760, 7277936),
    ),
    "google.com": (
        1, 86429287970, "28.77%", 8.289799908129233, "00:10:35",
        (87023594527, 85085372857, 86429287970), (1, 1, 1),
    ),
    "crunchbase.com": (
        7435, 9111589, "55.43%", 2.9857876699391332, "00:02:26",
        (10489281, 10549539, 9111589), (5721, 6054, 7435),
    ),
}
RIVAL = ("picpay.com", (17133, 14475, 18052))
COUNTRIES = {
    "pitchbook.com": (
        ("US", 0.48826514532758797), ("IN", 0.08866687957796864), ("GB", 0.06659665828304565),
        ("CA", 0.03476231168102413), ("DE", 0.02291392944270491),
    )
}
AGES = {
    "pitchbook.com": (
        (25, 34, 0.34567403890509263), (35, 44, 0.21402568463627616),
        (18, 24, 0.19450404553704798), (45, 54, 0.12858719329114432),
        (55, 64, 0.07430017516655608), (65, None, 0.04290886246388305),
    )
}

SECONDS = {
    "pitchbook.com": 248, "stripe.com": 224, "google.com": 635, "crunchbase.com": 146,
    "byte-trading.com": None,
}
COUNTRY_PERCENT = {"US": 48.83, "IN": 8.87, "GB": 6.66, "CA": 3.48, "DE": 2.29}
AGE_PERCENT = {
    "25-34": 34.57, "35-44": 21.4, "18-24": 19.45, "45-54": 12.86, "55-64": 7.43, "65+": 4.29,
}
GROWTH = {
    "byte-trading.com": (None, None, None),
    "crunchbase.com": (None, 0.57, -13.63),
    "google.com": (None, -2.23, 1.58),
    "pitchbook.com": (None, 4.74, -16.81),
    "stripe.com": (None, 5.47, 2.99),
}
RANK_CHANGE = {
    "byte-trading.com": ((None, -4161244, 2350824), (None, 76.11, -24.41)),
    "crunchbase.com": ((None, -333, -1381), (None, 5.82, 22.81)),
    "google.com": ((None, 0, 0), (None, 0.0, 0.0)),
    "pitchbook.com": ((None, 506, -3379), (None, -3.33, 23.03)),
    "stripe.com": ((None, 51, 18), (None, -4.51, -1.67)),
}
RANKING = [
    ("stripe.com", 8.62, 69, 1, 1, 2),
    ("google.com", -0.68, 0, 2, 2, 4),
    ("crunchbase.com", -13.13, -1714, 4, 3, 7),
    ("pitchbook.com", -12.87, -2873, 3, 4, 7),
    ("byte-trading.com", None, -1810420, 5, 5, 10),
]


def history(ranks):
    return [{"date": f"{m}T00:00:00+00:00", "rank": r} for m, r in zip(MONTHS, ranks)]


def document(domain):
    rank, total, bounce, pages, duration, visits, ranks = SITES[domain]
    return {
        "layout": {
            "data": {
                "domain": domain,
                "overview": {
                    "globalRank": rank, "visitsTotalCount": total, "bounceRateFormatted": bounce,
                    "pagesPerVisit": pages, "visitsAvgDurationFormatted": duration, "extra": [1],
                },
                "ranking": {
                    "globalRankCompetitorsHistory": {
                        domain: history(ranks), RIVAL[0]: history(RIVAL[1]),
                    }
                },
                "traffic": {"visitsHistory": dict(zip(MONTHS, visits)), "visitsTotalCountChange": -0.5},
                "geography": {
                    "topCountriesTraffics": [
                        {"countryAlpha2Code": c, "countryUrlCode": c, "visitsShare": s,
                         "visitsShareChange": 0.1}
                        for c, s in COUNTRIES.get(domain, ())
                    ]
                },
                "demographics": {
                    "ageDistribution": [
                        {"minAge": low, "maxAge": high, "value": v}
                        for low, high, v in AGES.get(domain, ())
                    ]
                },
            }
        }
    }


def page(domain, blob=None):
    blob = json.dumps(document(domain)) if blob is None else blob
    return f"<html><head><script>window.__APP_DATA__ = {blob}</script></head><p>text</p></html>"
