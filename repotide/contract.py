"""The record contract and the default parameters of every operator."""

from pyspark.sql import types as T

# One repository record. `seq` is the arrival order: unique, carried in the data.
REPO_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("pushed_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

# The fields a search item is cut down to before it is sent on.
WIRE_FIELDS = ("id", "name", "language", "description", "stargazers_count", "pushed_at")
WIRE_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Defaults of the analytics.
LANGUAGES = ("Python", "Java", "JavaScript")
BATCH_INTERVAL = "60 seconds"
RECENT_PUSH_AGE = "60 seconds"
AVERAGE_DIGITS = 2
TOP_WORDS = 10
VOCABULARY_SIZE = 1000
TOPIC_MIN_DOCS = 5
TOPIC_MIN_DF = 2
TOPICS = 5
TOPIC_ITERATIONS = 10
# Share of a language's texts that an iteration draws; 1.0 lets every iteration draw from all.
TOPIC_SUBSAMPLING = 1.0
# Vectors in one of the partitions that a language's are dealt to by id. Topics depend on the
# number of texts and the seed, not on the cluster.
TOPIC_PARTITION_ROWS = 20_000
TOPIC_WORDS = 5
TOPIC_WORDS_SHOWN = 3
TOP_ENTITIES = 5
TOP_ENTITIES_SHOWN = 3
SIMILARITY_MIN_DOCS = 3
SIMILARITY_MIN_DF = 1
SIMILARITY_BAND = 5
SIMILARITY_THRESHOLD = 0.1
SIMILARITY_DIGITS = 3
TOP_PAIRS = 5
SNIPPET_CHARS = 50
SYNTHETIC_MONTHS = 6
SYNTHETIC_STEP_DAYS = 30
TREND_WINDOW = 3
TREND_UP = 10.0
TREND_DOWN = -10.0
MONTHS_SHOWN = 6

# The entity dictionary, 19 patterns for each of four types. Order matters:
# it breaks ties between entities first mentioned by the same repository.
ENTITIES = {
    "companies": (
        "google", "microsoft", "amazon", "facebook", "apple", "netflix", "uber", "airbnb",
        "twitter", "github", "gitlab", "docker", "kubernetes", "ibm", "oracle",
        "salesforce", "adobe", "intel", "nvidia",
    ),
    "frameworks": (
        "react", "angular", "vue", "django", "flask", "spring", "express", "fastapi",
        "rails", "laravel", "symfony", "tensorflow", "pytorch", "keras", "scikit-learn",
        "pandas", "numpy", "spark", "hadoop",
    ),
    "tools": (
        "docker", "kubernetes", "jenkins", "git", "webpack", "babel", "npm", "yarn",
        "maven", "gradle", "redis", "postgresql", "mysql", "mongodb", "elasticsearch",
        "kafka", "aws", "azure", "gcp",
    ),
    "technologies": (
        "ai", "ml", "machine learning", "deep learning", "blockchain", "iot", "ar", "vr",
        "microservices", "serverless", "devops", "cicd", "big data", "cloud", "mobile",
        "web", "api", "rest", "graphql",
    ),
}

# Spark ML's default English stop words (StopWordsRemover), 181 words.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what which
    who whom this that these those am is are was were be been being have has had having do
    does did doing a an the and but if or because as until while of at by for with about
    against between into through during before after above below to from up down in out on
    off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will
    just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
    they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
    wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
    what's when's where's who's why's would
    """.split()
)
