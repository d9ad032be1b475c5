"""Tables and vocabularies of the statement pipeline."""

from __future__ import annotations

MATCH = "struct<keyword:string,lang:string,start:int,end:int>"
# Sub-scores of the two topics that have them.
RISK_SCORES = ["misuse", "loss_of_control", "natsec_stability", "cbrn", "socioeconomic"]
REGULATION_SCORES = ["export_controls", "standards_certification", "auditing", "international_coordination", "military_defense", "surveillance", "alignment", "adversarial_robustness"]
SUB_RISK = f"struct<{','.join(f'{k}:int' for k in RISK_SCORES)}>"
SUB_REGULATION = f"struct<{','.join(f'{k}:int' for k in REGULATION_SCORES)}>"
RELEVANCE = f"struct<ai:int,agi:int,asi:int,rsi:int,x_risk:int,regulation:int,x_risk_sub:{SUB_RISK},regulation_sub:{SUB_REGULATION}>"
VERDICT = f"struct<relevance:{RELEVANCE},rationale:string,quote_span:string,quote_en:string,is_substantive:boolean,speaker_owns_statement:boolean,quote_type:string,speaker_in_scope:boolean,trigger_phrases:array<string>,stance:string,context_note:string,speaker_name:string>"
REFINEMENT = "struct<coarse_topics:array<string>,risk_subdomains:array<string>,policy_instruments:array<string>,primary_topic:string,rationale:string,display_quote:string,display_quote_en:string>"

TABLES = {
    "raw_fetches": "id long, source string, url string, method string, request_body string, fetched_at timestamp, status_code int, content_sha256 string, content_type string, encoding string, extraction_method string, note string",
    "documents": "id long, source string, native_id string, url string, citation_url string, doc_date date, date_precision string, title string, language string, doc_type string, version_hash string, is_provisional boolean, raw_fetch_id long, parsed_at timestamp, meta string",
    "utterances": "id long, document_id long, seq int, speaker_raw string, speaker_native_id string, language string, text string, speech_context string, is_verbatim boolean, meta string",
    "candidates": f"id long, utterance_id long, keyword_version string, matches array<{MATCH}>, created_at timestamp, status string",
    "adjudications": "id long, candidate_id long, model string, provider string, prompt_sha256 string, role string, verdict string, raw_response string, error string, created_at timestamp, cache_key string",
    "speakers": "id string, canonical_name string, jurisdiction string, wikidata_id string, meta string",
    "speaker_source_ids": "speaker_id string, source string, native_id string",
    "speaker_roles": "id long, speaker_id string, role string, body string, party string, start_date date, end_date date",
    "quotes": "candidate_id long, adjudication_id long, speaker_id string, speaker_display string, speaker_resolution string, jurisdiction string, source string, date date, date_precision string, quote_original string, quote_en string, concepts array<string>, stance string, quote_type string, review_status string, trigger_phrases array<string>, context string, source_url string, language string, span_key string, statement_key string, extraction_method string, mirrors array<struct<source:string,url:string,date:date>>",
    "refinements": "id long, candidate_id long, model string, provider string, prompt_sha256 string, verdict string, raw_response string, error string, created_at timestamp, cache_key string",
    "validation_samples": "judge string, seed long, lang string, position int, candidate_id long, adjudication_id long, jurisdiction string, year string, judge_accept boolean",
    "validation_labels": "judge string, seed long, candidate_id long, agreement string, human_accept boolean, note string, blind boolean, seconds double, labelled_at timestamp",
    "label_validation_samples": "seed long, position int, candidate_id long, refinement_id long, family string, label string, applied boolean, sel_p double",
    "label_validation_labels": "seed long, candidate_id long, family string, label string, agreement string, human_applies boolean, note string, labelled_at timestamp",
    "watermarks": "source string, window_start date, window_end date, status string, updated_at timestamp, note string",
}

# Fixed vocabularies and bars.
TOPICS = ["agi", "asi", "rsi", "x_risk", "regulation"]
BARS = {"agi": 5, "asi": 5, "rsi": 5, "x_risk": 30, "regulation": 60}
COARSE_TOPICS = ["agi", "asi", "rsi", "x_risk", "regulation"]
FRONTIER_TOPICS = ["agi", "asi", "rsi"]
QUOTE_TYPES = ["direct", "official_paraphrase", "reported"]
STANCES = ["concerned", "dismissive", "optimistic", "mixed", "neutral"]
RISK_SUBDOMAINS = [
    "unfair_discrimination",
    "toxic_content",
    "unequal_performance",
    "privacy_compromise",
    "ai_system_vulnerabilities",
    "false_information",
    "information_ecosystem_pollution",
    "disinformation_influence_at_scale",
    "cyberattacks_and_weapons",
    "fraud_and_manipulation",
    "overreliance_unsafe_use",
    "loss_of_human_agency",
    "power_centralization",
    "inequality_employment",
    "devaluation_of_human_effort",
    "competitive_dynamics",
    "governance_failure",
    "environmental_harm",
    "misalignment_loss_of_control",
    "dangerous_capabilities",
    "lack_of_robustness",
    "lack_of_transparency",
    "ai_welfare_rights",
    "multi_agent_risks",
]
POLICY_INSTRUMENTS = [
    "convening",
    "disclosure_requirements",
    "evaluation_auditing",
    "governance_development",
    "government_study",
    "government_support",
    "compute_controls",
    "data_controls",
    "licensing_and_registration",
    "new_institution",
    "performance_requirements",
    "pilots_and_testbeds",
    "risk_tiering",
]
MULTILINGUAL_TAGS = ["mul", "und", ""]
CJK_LANGUAGES = ["zh", "ja", "ko"]
EXECUTIVE_SOURCES = ["us_fedreg", "us_whitehouse", "fr_elysee", "ru_kremlin"]
OFFICIAL_ENGLISH_SOURCES = ["cn_mfa", "cn_gov", "cn_cac", "cn_people", "cn_gold"]
#: Two-letter source prefixes and the jurisdictions they stand for.
SOURCE_PREFIXES = {"uk": "UK", "us": "US", "ep": "EU", "ec": "EU", "eu": "EU", "de": "DE", "fr": "FR", "jp": "JP", "ca": "CA", "ch": "CH", "sg": "SG", "br": "BR", "mx": "MX", "za": "ZA", "au": "AU", "nl": "NL", "ru": "RU", "tw": "TW", "cn": "CN"}
INTERNATIONAL_SOURCES = {"intl_nato": "NATO", "intl_un": "UN", "intl_un_webtv": "UN"}
