"""The word lists of the aspect extractor and the question router."""

# Aspects and their keywords; the first keyword of a list that a text contains counts.
ASPECTS: dict[str, tuple[str, ...]] = {
    "battery": ("battery", "batteries", "charge cycle", "holds a charge", "holds charge"),
    "charging": ("charging", "charger", "fast charge", "usb-c", "usb c", "cable", "ports", "port"),
    "overheating": ("overheat", "overheats", "overheating", "too hot", "gets hot", "hot to touch"),
    "sound_quality": ("sound quality", "audio", "bass", "treble", "anc", "noise cancel", "noise canceling", "noise-cancelling", "noise cancelling", "mic", "microphone", "volume"),
    "bluetooth": ("bluetooth", "pair", "pairing", "paired", "connect", "connecting", "connection", "latency", "range", "drops out", "drop out", "drops"),
    "delivery": ("delivery", "shipping", "shipped", "package", "packaging", "arrived", "missing item", "missing items", "wrong item"),
    "price": ("price", "value", "expensive", "cheap", "overpriced", "worth the money", "for the money"),
}
ONTOLOGY_V1 = tuple(ASPECTS)
ONTOLOGY_V2 = (*ONTOLOGY_V1, "reliability")
SENTIMENTS = ("positive", "neutral", "negative")
SEVERITIES = ("low", "medium", "high")

# Markers of sentiment and severity.
NEGATIVE = (
    "broke", "broken", "stopped working", "doesn't work", "does not work", "stopped", "dead", "useless", "garbage", "terrible", "awful", "bad",
    "disappointed", "refund", "return", "returned", "waste", "scam", "horrible", "poor", "fail", "failed", "failure", "junk", "issue", "issues",
    "problem", "problems", "won't", "wouldn't", "couldn't", "no longer", "stop", "stops", "slow", "weak", "cheap quality", "not worth", "overpriced",
    "not happy", "unhappy", "complaint", "complaints", "annoying", "lousy", "subpar", "defective", "dead on arrival", "doa", "poor quality",
    "not working anymore", "quit working", "lasted only", "stopped after", "died",
)
POSITIVE = (
    "great", "excellent", "amazing", "love", "perfect", "fantastic", "best", "awesome", "good", "solid", "happy", "satisfied",
    "recommend", "fast", "worth", "value", "decent",
)
HIGH = (
    "fire", "smoke", "burned", "burning", "burnt", "shock", "shocked", "hospital", "danger", "dangerous", "exploded", "explode", "explosion",
    "melted", "refused refund",
)
MEDIUM = (
    "unusable", "returned", "broken", "never worked", "dead on arrival", "doesn't work", "does not work", "broke after", "stopped working",
    "defective", "doa", "not working anymore", "quit working", "stopped after", "died",
)

# The catch-all aspect and its guards.
RELIABILITY = (
    "stopped working", "stopped after", "not working anymore", "quit working", "lasted only", "dead on arrival", "doa", "defective",
    "poor quality", "broken", "broke", "died", "failed",
)
SHIPPING = ("package", "packaging", "shipping", "shipped", "shipment")
PRODUCT_FAILURE = ("broke", "broken", "defective", "dead on arrival", "doa", "stopped working", "died", "failed")

# Words that send a question to a route, in this order of routes.
INCIDENT_WORDS = (
    "incident", "incidents", "spike", "spiked", "spiking", "anomaly", "anomalies", "emerging", "emerge", "surge", "surging", "getting worse",
    "trending up", "ramping",
)
ANALYTICS_WORDS = (
    "how many", "how much", "count", "counts", "distribution", "distributions", "top aspect", "top aspects", "most common", "most negative",
    "most frequent", "breakdown", "percentage", "proportion", "share of", "statistics", "stats", "overall sentiment", "severity breakdown",
    "absa status",
)
RETRIEVAL_WORDS = (
    "complaint", "complaints", "complaining", "customers say", "customer say", "customers saying", "users say", "users saying", "people say",
    "reviews", "review", "quote", "quotes", "example", "examples", "saying about", "say about", "feedback", "evidence", "what do customers",
    "what are users",
)
# Phrasings of aspects in questions, in order.
ASPECT_ALIASES = {
    "reliability": "reliability", "reliable": "reliability", "broke": "reliability", "broken": "reliability", "stopped working": "reliability",
    "bluetooth": "bluetooth", "pairing": "bluetooth", "disconnect": "bluetooth", "charging": "charging", "charge": "charging", "charger": "charging",
    "price": "price", "value": "price", "expensive": "price", "cost": "price", "delivery": "delivery", "shipping": "delivery", "packaging": "delivery",
    "sound quality": "sound_quality", "sound_quality": "sound_quality", "audio": "sound_quality", "overheating": "overheating",
    "overheat": "overheating", "too hot": "overheating", "battery": "battery",
}
POSITIVE_HINTS = ("positive", "praise", "love", "like about", "good about", "happy", "best")
NEGATIVE_HINTS = (
    "negative", "complaint", "complaints", "complaining", "problem", "problems", "issue", "issues", "fail", "failure", "failing", "bad", "worst",
    "broken", "disappoint",
)
# Brands with their aliases, and what a match in a metadata field is worth.
BRANDS = {
    "Anker": ("anker", "anker innovations", "ankerdirect", "anker direct"),
    "Soundcore": ("soundcore", "soundcore by anker"),
    "Bose": ("bose",),
    "JBL": ("jbl",),
    "UGREEN": ("ugreen",),
    "RAVPower": ("ravpower", "rav power"),
    "Aukey": ("aukey",),
}
FIELD_WEIGHTS = {"details.Brand": 100, "store": 90, "details_json": 50, "title": 30, "categories": 20}
# Stop words of cluster labels and of answers.
LABEL_STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "is", "are", "was", "were", "it", "its", "this", "that", "to", "of", "for", "on", "in", "with", "my",
    "me", "i", "you", "they", "very", "really", "just", "so", "would", "could", "get", "got", "one", "also", "even", "product", "item", "thing",
    "amazon",
)
ANSWER_STOP_WORDS = tuple(
    "a an and are about as at be been but by can could did do does for from had has have how in into is it its of on or that the their them "
    "then there these they this to was were what when where which who why will with would you your".split()
)
