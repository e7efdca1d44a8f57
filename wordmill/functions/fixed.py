"""Fixed values.

Every value in this module must stay exactly as written: results are only
comparable with the original experiments when these match word for word.
They are listed in their natural order and are not derived from anything.
"""

from __future__ import annotations

# --- Fixed values: English stopword list (the classic 179-word NLTK list) ---
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what",
    "which", "who", "whom", "this", "that", "that'll", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "having",
    "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very",
    "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn",
    "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't",
    "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn",
    "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]

# --- Fixed values: contractions added to the frequency-based stopword set ---
CONTRACTIONS = ["'s", "'re", "'ve", "'ll", "'d", "n't"]

# --- Fixed values: frequency threshold for data-driven stopwords ---
FREQUENCY_THRESHOLD = 0.001

# --- Fixed values: class codes and names of the emotion dataset ---
LABEL_NAMES = {0: "Sadness", 1: "Joy", 2: "Love", 3: "Anger", 4: "Fear", 5: "Surprise"}
EMOTIONS = ["sadness", "joy", "love", "anger", "fear", "surprise"]
EMOTION_CODES = {"sadness": 0, "joy": 1, "love": 2, "anger": 3, "fear": 4, "surprise": 5}

# --- Fixed values: custom vocabulary of the document-dictionary notebook ---
CUSTOM_VOCAB = ["machine", "learning", "artificial", "intelligence", "neural", "network"]

# --- Fixed values: experiment parameters ---
BASELINE_SEED = 100
BASELINE_VALID_SHARE = 0.20
NUM_PERCENTILES = 20
LADDER_RANGE = (1, 21, 4)          # i / NUM_PERCENTILES for i in range(1, 21, 4)
GENERATED_SPLIT_SEED = 42
GENERATED_TEST_SHARE = 0.2
PROMPT_VALID_SHARE = 0.2
FEW_SHOT_VALID_SHARE = 0.5
STRATIFIED_TEST_SHARE = 0.1
MAX_SEQ_LEN = 128
CONTRASTIVE_ITERATIONS = 20
LR_MAX_ITER = 100

# --- Fixed values: classification prompt (key, value) blocks, in order ---
PROMPT_BLOCKS = [
    ("instruction", "Classify the following text into one of these emotions: "
                    "sadness, joy, love, anger, fear, surprise."),
    ("notice", "Notice that the labels are 0, 1, 2, 3, 4, 5 respectively, each for the "
               "corresponding emotion. The equivalences are given in the following list."),
    ("equivalences", "{'0': 'sadness', '1': 'joy', '2': 'love', '3': 'anger', "
                     "'4': 'fear', '5': 'surprise'}"),
    ("response_instruction", "Only respond with the emotion label with the equivalent "
                             "number, nothing else."),
]
PROMPT_EXAMPLES_HEADER = "\n\nHere are some examples:\n"
PROMPT_EXAMPLE_FORMAT = ("Text: ", "\nEmotion: ", "\n\n")
PROMPT_ITEM_FORMAT = ("\nText: ", "\n\nEmotion:")

# --- Fixed values: generation prompts ---
GENERATION_INSTRUCTION = "Generate a text expressing the given emotion."
GENERATION_NOTICE = "Do not include any numbers in the text."
PLAIN_GENERATION_FORMAT = "Generate a text expressing %s."

# --- Fixed values: the six example paragraphs of the document-dictionary notebook ---
EXAMPLE_DOCUMENTS = [
    "Machine learning is a subset of artificial intelligence that focuses on creating systems that can learn from and make decisions based on data. It utilizes statistical techniques to enable computers to improve their performance on a specific task progressively. Machine learning algorithms build a model based on sample data, known as training data, to make predictions or decisions without being explicitly programmed to do so. Some popular machine learning techniques include supervised learning, unsupervised learning, and reinforcement learning.",
    "Natural language processing is a field of AI that deals with the interaction between computers and humans using natural language. It combines computational linguistics, machine learning, and deep learning models to process and analyze large amounts of natural language data. NLP tasks include speech recognition, natural language understanding, and natural language generation. Applications of NLP are widespread, including machine translation, sentiment analysis, chatbots, and voice assistants.",
    "Deep learning is part of a broader family of machine learning methods based on artificial neural networks. It uses multiple layers to progressively extract higher-level features from raw input. For example, in image processing, lower layers may identify edges, while higher layers may identify concepts relevant to a human such as digits or letters or faces. Deep learning has produced results comparable to and in some cases superior to human experts in various fields, including computer vision, speech recognition, natural language processing, and playing complex games.",
    "The stock market is a complex system where shares of publicly-traded companies are issued, bought and sold. It serves as a platform for companies to raise capital and for investors to own parts of businesses, potentially profit from their growth. The stock market is influenced by various factors including economic indicators, company performance, geopolitical events, and investor sentiment. Stock prices can be volatile, reflecting the constant flow of information and changing market dynamics. Major stock exchanges include the New York Stock Exchange (NYSE) and NASDAQ in the United States.",
    "Animals are a diverse group of multicellular eukaryotic organisms that form the biological kingdom Animalia. They are capable of locomotion, reproduce sexually, and feed on organic matter. Animals have evolved a wide range of adaptations to survive in various environments, from the depths of the oceans to the driest deserts. They play crucial roles in ecosystems as predators, prey, pollinators, and decomposers. The study of animals, known as zoology, encompasses various sub-disciplines including ethology (animal behavior), ecology, and evolutionary biology.",
    "Art is a diverse range of human activities involving creative imagination to express technical proficiency, beauty, emotional power, or conceptual ideas. It encompasses various forms including painting, sculpture, literature, music, dance, and photography. Throughout history, art has been a powerful medium for cultural expression, social commentary, and personal exploration. It often reflects the social, political, and technological contexts of its time. The interpretation and appreciation of art can be highly subjective, leading to ongoing debates about its nature, purpose, and value in society.",
]

