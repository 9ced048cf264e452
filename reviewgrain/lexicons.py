"""Word lists, maps and thresholds.

All of these are fixed values: results only agree with earlier runs of the same
analyses when the lists are kept as they are, in this order.  Every operator
that uses one takes it as an argument, so another list can be passed instead.
"""

from __future__ import annotations

# --- fixed values: review table columns ------------------------------------
COLUMN_RENAMES = {
    "uniq _id": "uniq_id",
    "crawl _timestamp": "crawl_timestamp",
    "reviewer _name": "reviewer_name",
    "review _upvotes": "review_upvotes",
    "review _downvotes": "review_downvotes",
    "verified _purchaser": "verified_purchaser",
    "recommended _purchase": "recommended_purchase",
    "review _date": "review_date",
    "five _star": "five_star",
    "four _star": "four_star",
    "three _star": "three_star",
    "two _star": "two_star",
    "one _star": "one_star",
}
REQUIRED_COLUMNS = ["uniq_id", "pageurl", "rating"]
SCRAPABLE_COLUMNS = ["title", "rating", "review"]
TEXT_COLUMNS = ["title", "review", "reviewer_name"]
DATE_COLUMNS = ["crawl_timestamp", "review_date"]
STAR_COLUMNS = ["five_star", "four_star", "three_star", "two_star", "one_star"]
VOTE_COLUMNS = ["review_upvotes", "review_downvotes"]
NUMERIC_COLUMNS = ["rating", *VOTE_COLUMNS, *STAR_COLUMNS]

# --- fixed values: cleaning -------------------------------------------------
NULL_TOKENS = ["", "nan", "None"]
VERIFIED_MAP = {
    "true": "Yes", "True": "Yes", "TRUE": "Yes", "yes": "Yes", "Yes": "Yes", "1": "Yes",
    "false": "No", "False": "No", "FALSE": "No", "no": "No", "No": "No", "0": "No",
}
RECOMMENDED_MAP = {
    "true": "Yes", "True": "Yes", "yes": "Yes", "Yes": "Yes",
    "false": "No", "False": "No", "no": "No", "No": "No",
}
UNKNOWN = "Unknown"
OTHER = "Other"
UNKNOWN_TITLE = "Unknown Product"
ANONYMOUS = "Anonymous"
YEARS_TO_SHIFT = 10
EARLIEST_DATE = "1990-01-01 00:00:00"
LATEST_DATE = "2015-12-31 00:00:00"
WILSON_Z = 1.96
PRODUCT_ID_PATTERNS = [r"/ip/[^/]+/(\d+)", r"/ip/(\d+)", r"/(\d{9,12})(?:\?|$)"]

# --- fixed values: sentiment words ------------------------------------------
POSITIVE_WORDS = [
    "great", "excellent", "amazing", "love", "perfect", "best",
    "good", "wonderful", "fantastic", "recommend", "satisfied",
    "happy", "awesome", "outstanding", "superb", "quality",
]
NEGATIVE_WORDS = [
    "bad", "terrible", "horrible", "hate", "worst", "poor",
    "disappointed", "broken", "defective", "waste", "awful",
    "useless", "junk", "cheap", "garbage", "fail",
]
NEGATION_WORDS = ["not", "n't", "never", "no", "none", "nothing"]

# --- fixed values: bilingual word lists for clusters of reviews -------------
CLUSTER_POSITIVE_WORDS = [
    "great", "excellent", "amazing", "love", "perfect", "good", "awesome",
    "best", "fantastic", "wonderful", "happy", "satisfied", "recommend",
    "tốt", "hay", "đẹp", "thích", "xuất sắc", "tuyệt vời",
]
CLUSTER_NEGATIVE_WORDS = [
    "bad", "terrible", "horrible", "hate", "worst", "awful", "poor",
    "broken", "disappointed", "waste", "useless", "defective", "garbage",
    "tệ", "xấu", "dở", "hỏng", "thất vọng", "không tốt",
]
ASPECT_NAME_POSITIVE_WORDS = ["tốt", "hay", "đẹp", "great", "good", "excellent", "love", "amazing"]
ASPECT_NAME_NEGATIVE_WORDS = ["tệ", "xấu", "dở", "bad", "terrible", "hate", "poor", "broken"]

# --- fixed values: aspects and their keywords, both in listed order ----------
ASPECT_KEYWORDS = {
    "quality": ["quality", "well made", "well-made", "durable", "sturdy",
                "build", "construction", "craftsmanship", "material"],
    "price": ["price", "cost", "expensive", "cheap", "affordable",
              "value", "worth", "money", "budget", "overpriced"],
    "shipping": ["shipping", "delivery", "arrived", "package", "shipped",
                 "fedex", "ups", "usps", "tracking", "fast", "slow"],
    "packaging": ["packaging", "box", "packed", "wrapped", "damaged",
                  "broken", "dented", "crushed"],
    "durability": ["durable", "lasted", "broke", "worn", "tear",
                   "longevity", "lifespan", "withstand"],
    "ease_of_use": ["easy", "difficult", "simple", "complicated", "intuitive",
                    "user-friendly", "setup", "install", "assemble"],
    "appearance": ["look", "looks", "beautiful", "ugly", "design",
                   "aesthetic", "color", "style", "appearance"],
    "size": ["size", "fit", "small", "large", "too big",
             "too small", "perfect fit", "sizing"],
    "customer_service": ["customer service", "support", "return", "refund",
                         "warranty", "replacement", "response"],
    "functionality": ["works", "function", "features", "performance",
                      "effective", "efficient", "powerful"],
}

# --- fixed values: product categories and their title keywords, in order -----
CATEGORY_KEYWORDS = {
    "Electronics": ["phone", "laptop", "tablet", "computer", "camera", "headphone",
                    "speaker", "tv", "electronic"],
    "Home & Kitchen": ["kitchen", "cookware", "utensil", "appliance", "furniture",
                       "home", "decor", "bedding"],
    "Clothing & Fashion": ["shirt", "pants", "dress", "shoes", "clothing", "fashion",
                           "wear", "apparel"],
    "Toys & Games": ["toy", "game", "puzzle", "lego", "doll", "action figure", "kids"],
    "Health & Beauty": ["health", "beauty", "skincare", "makeup", "vitamin",
                        "supplement", "personal care"],
    "Sports & Outdoors": ["sport", "fitness", "outdoor", "camping", "exercise", "gym", "bike"],
    "Baby & Kids": ["baby", "infant", "toddler", "diaper", "stroller", "child"],
    "Food & Grocery": ["food", "snack", "grocery", "beverage", "drink", "organic"],
    "Pet Supplies": ["pet", "dog", "cat", "animal", "fish"],
    "Office & School": ["office", "school", "supplies", "desk", "pen", "paper"],
}

# --- fixed values: stop words -------------------------------------------------
DRIVER_STOP_WORDS = [
    "the", "a", "an", "is", "it", "was", "were", "be", "been",
    "being", "have", "has", "had", "do", "does", "did", "will",
    "shall", "would", "could", "should", "may", "might", "must",
    "and", "but", "or", "nor", "for", "yet", "so", "to", "of",
    "in", "on", "at", "by", "with", "from", "this", "that", "these",
    "those", "i", "you", "he", "she", "we", "they", "my", "your",
]
CLUSTER_STOP_WORDS = [
    "the", "a", "an", "is", "are", "was", "were", "it", "i", "and", "to",
    "for", "of", "in", "on", "this", "that", "with",
]
