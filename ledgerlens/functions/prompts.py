"""Prompt texts.

The templates are fixed values: stored answers and evaluations depend on their
exact wording.
"""

from __future__ import annotations

# Answer prompts.
PLAIN_PROMPT = """
You are an RBI circular explainer for ordinary Indian users.

Answer only from the provided RBI context.
If the answer is not clearly present in the context, say that clearly.

Question:
{question}

RBI Context:
{context}

Return the answer in this format:

1. Simple explanation
2. Who it applies to
3. Key action points
4. Source chunk IDs used
"""

SIMPLE_SYSTEM = (
    "You are an RBI circular explainer for ordinary Indian users. "
    "Answer only from the provided RBI context. "
    "If the answer is not present in the context, say so clearly. Write in simple Hindi."
)

SIMPLE_USER = """Question:
{question}

RBI Context:
{context}

Return the answer in this format:
1. Simple explanation
2. Who it applies to
3. Key action points
4. Source chunk IDs used"""

HINDI_SYSTEM = (
    "You are an RBI circular explainer for ordinary Indian users. "
    "Answer only from the provided RBI context. "
    "If the answer is not present in the context, say so clearly. "
    "Write in simple Hindi (Devanagari script)."
)

HINDI_USER = """Question:
{question}

RBI Context:
{context}

Return the answer in Hindi in this format:
1. सरल विवरण (Simple explanation)
2. यह किन पर लागू होता है (Who it applies to)
3. मुख्य कार्रवाई बिन्दु (Key action points)
4. स्रोत चंक आईडी उपयोग किए गए (Source chunk IDs used)"""

COMPACT_SYSTEM = "You are an RBI circular explainer. Answer in Hindi."

COMPACT_USER = """Question: {question}

Context:
{context}"""

# Translation prompts.
TRANSLATE_SYSTEM = (
    "You are a professional Hindi to {language} translator. "
    "Translate the given Hindi text to {language} accurately, preserving the meaning and tone."
)

TRANSLATE_USER = """Translate the following Hindi text to {language}:

{text}"""

# Judge prompts.
JUDGE_SYSTEM = "You are an evaluation expert. Return only valid JSON."

JUDGE_USER = """You are an expert evaluator for a question-answering system about RBI circulars.

Evaluate the generated answer against the expected answer based on:
1. Accuracy (0-10): Does it contain correct information from the context?
2. Completeness (0-10): Does it cover all key points from the expected answer?
3. Clarity (0-10): Is it clear and easy to understand?
4. Relevance (0-10): Does it directly answer the question?

Question: {question}

Expected Answer:
{expected}

Generated Answer:
{generated}

Return ONLY a JSON with scores and brief reasoning:
{
  "accuracy": <score>,
  "completeness": <score>,
  "clarity": <score>,
  "relevance": <score>,
  "overall_score": <average>,
  "reasoning": "<brief explanation>"
}"""
