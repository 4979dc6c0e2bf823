"""Fixed values that must equal the reference's for identical output.

These are plain data, stated once, in the reference's natural order.
"""

# -- fixed values -----------------------------------------------------------
# Six emotion names, in label-vector position order (love, joy, fright,
# anger, fear, sorrow).
EMOTION_NAMES = ["热爱", "快乐", "惊恐", "愤怒", "恐惧", "哀伤"]
# Level words for levels 1, 2, 3 ("a little", "very", "extremely").
LEVEL_WORDS = ["有点", "很", "极度"]
# Text rendered for a label vector with no non-zero entry ("none").
NO_LABEL_TEXT = "无"
# Fill value for a missing character name in the label-free scripts ("no role").
NO_ROLE = "无角色"
# Sentinel written into missing character / emotions by the preparation step.
SENTINEL = "99"
# Template A separator (" role: ") and template D wrapper ("(describe role: ... )").
ROLE_MARK = " 角色: "
DESCRIBE_OPEN = "（描述角色："
DESCRIBE_CLOSE = " ）"
# Bucket letters for the six emotions, used in bucket names such as "A1".
BUCKET_LETTERS = ["A", "B", "C", "D", "E", "F"]
# Buckets that the rebalancing step doubles with a rewritten copy.
DOUBLED_BUCKETS = ["A1", "A2", "A3", "B2", "B3", "C2", "C3", "D3", "E3"]
# Punctuation removed by the short and the long strip sets.
PUNCT_SHORT = "。，、“、？（）！"
PUNCT_LONG = "。: ！？｡＂＃＄％＆＇（）＊＋，－／：；＜＝＞＠［＼］＾＿｀｛｜｝～｟｠｢｣､、〃》「」『』【】〔〕〖〗〘〙〚〛〜〝〞〟〰〾〿–—‘’‛“”„‟…‧﹏."
# Example prediction-file weights used by the weighted vote (first file heaviest).
EXAMPLE_FILE_WEIGHTS = [2.0, 1.8, 1.6]
# Rank weights of the ranked vote start at this base and drop by one per rank.
RANK_WEIGHT_BASE = 5
# BERT-style special token ids used by the sequence packers.
CLS_ID = 101
SEP_ID = 102
PAD_ID = 0
# Default score range for clamping (ordinal levels 0..3).
SCORE_LO = 0.0
SCORE_HI = 3.0
# Default short-line threshold for attaching context and neighbours used.
CONTEXT_THRESHOLD = 70
CONTEXT_LINES = 3
# Vocabulary size cap of the character vocabulary.
VOCAB_SIZE = 10000
