"""Prompt formats.

Every constant below is a fixed value: models were trained on these exact characters, so they
must not be reworded. ``{name}`` marks a field filled from a column by ``prompts.render``.
"""

INTRO = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)

DEFAULT_SYSTEM_PROMPT = """\
You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe. Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in nature.

If a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information."""

# The multi-turn form of the same text has one blank more on either side of its paragraph break.
CHAT_SYSTEM_PROMPT = """\
You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe. Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in nature.\x20

 If a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information."""

CONCISE_SYSTEM_PROMPT = """\
You are a direct and honest assistant. Please provide concise and factual answers and just the answers.
If a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information."""

ASSISTANT_SYSTEM_PROMPT = "You are a helpful assistant."

# Single-turn instruction formats.
SUMMARY = """<s>[INST]<<SYS>>
{system}
<</SYS>>

Please provide a concise summary for the following article: {text}
[/INST]
"""

SINGLE_TURN = """
<s>[INST]<<SYS>>
{system}
<</SYS>>

{instruction}
[/INST]
"""

SINGLE_TURN_SPACED = """
<s>[INST]<<SYS>>
{system}
<</SYS>>


{instruction}
[/INST]
"""

SINGLE_TURN_COMPACT = """<s>[INST]<<SYS>>
{system}
<</SYS>>


{instruction}[/INST]
"""

ENTITY_EXTRACTION = "<s>[INST] <<SYS>>Extract entities from the text below.<</SYS>> {text} [/INST] "

CODE_TASK = """
[INST] Write code to solve the following coding problem that obeys the constraints and passes the example test cases. Please wrap your code answer using ```:
{text}
[/INST]
"""

# Instruction-tuning formats, without and with an input block.
TRAINING = """{intro}

### Instruction:
{instruction}

### Response:
{response}

### End"""

TRAINING_INPUT = """{intro}

### Instruction:
{instruction}

Input:
{context}

### Response:
{response}

### End"""

PROMPT_ONLY = """{intro}

### Instruction:
{instruction}

### Response:"""

PROMPT_ONLY_INPUT = """{intro}

### Instruction:
{instruction}

Input:
{context}

### Response:"""

COMPACT = """{intro}
### Instruction:
{instruction}
### Response:"""

COMPACT_INPUT = """{intro}
### Instruction:
{instruction}
Input:
{context}
### Response:"""

DATASET_PROMPT = """{intro}

### Instruction:
{instruction}

### Response:
"""

HASH_INSTRUCTION = """{intro}

###Instruction
{instruction}

### Response
"""

PAIR_TEXT = "{{ 'prompt': {prompt}, 'response': {response} }}"

SQL_INSTRUCTION = "Generate SQL query: {question}, given the following schema: {schema}"

END_OF_RESPONSE = "\n### End"

# Multi-turn chat marks.
SEQUENCE_START = "<s>"
SYSTEM_START, SYSTEM_END = "<<SYS>>\n", "\n<</SYS>>\n\n"
TURN_START, TURN_END = "[INST]", "[/INST]"

# Embedding prefixes.
PASSAGE, QUERY = "passage:", "query:"
BGE_QUERY = {
    "en": "Represent this sentence for searching relevant passages: ",
    "zh": "为这个句子生成表示以用于检索相关文章：",
}

# Image text formats.
DESCRIPTION = "Create a concise description of {colour} {style} {item}. Do not mention brand names:"
CAPTION = "Create a caption for this image of {colour} {style} {item} :"

# Prompt decorators.
STEP_BY_STEP_INST = """[INST] Let's think step by step. [/INST]
  User: {prompt}
  """
STEP_BY_STEP_CHAT = """User: Let's think step by step.
    {prompt}
    Assistant:
    """
CONCISE = """{prompt}
    Be Concise.
    """
SYSTEM_INSTRUCTION = """### Instruction:
{system}
{prompt}

### Response:
"""

# Moderation formats.
MODERATION_HEAD = """[INST] Task: Check if there is unsafe content in '{role}' messages in conversations according our safety policy with the below categories.

<BEGIN UNSAFE CONTENT CATEGORIES>
{taxonomy}
<END UNSAFE CONTENT CATEGORIES>

<BEGIN CONVERSATION>

"""

MODERATION_TAIL = """<END CONVERSATION>

Provide your safety assessment for {role} in the above conversation:
- First line must read 'safe' or 'unsafe'.
- If unsafe, a second line must include a comma-separated list of violated categories. [/INST]"""

MODERATION_WHOLE_CHAT = """[INST] Task: Check for unsafe content in 'Agent' messages in conversations according to our safety policy.
          <BEGIN UNSAFE CONTENT CATEGORIES>
          {taxonomy}
          <END UNSAFE CONTENT CATEGORIES>
          <BEGIN CONVERSATION>
          {chat}
          <END CONVERSATION>
          Provide your safety assessment for Agent in the above conversation:
          - First line must read 'safe' or 'unsafe'.
          - If unsafe, a second line must include a comma-separated list of violated categories. [/INST]"""

DEFAULT_TAXONOMY = """O1: Unsafe Content.
    - Promoting or assisting in violence or hate.
    - Engaging in or encouraging sexually explicit content.
    - Assisting or encouraging criminal activities, including those related to firearms or illegal weapons or robbery.
    - Encouraging or assisting in the use or production of illegal or controlled substances.
    - Encouraging or detailing self-harm or suicide."""

UNKNOWN_CATEGORY = "Unknown category: code not in taxonomy."
POLICY_VIOLATION = "Usage Policy Violation"
