"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from . import clustering, collocations, decontaminate, katz, language, licenses, line_dedup, main_text, media, mixing, simhash, substring_dedup, suffix_dedup

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_katz_scores": katz.op4_katz_scores,
    "op5_language_id": language.op5_language_id,
    "op6_progressive_jpeg": media.op6_progressive_jpeg,
    "op7_simhash_components": simhash.op7_simhash_components,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_centroid_clusters": clustering.op11_centroid_clusters,
    "op12_collocations": collocations.op12_collocations,
    "op13_main_text": main_text.op13_main_text,
}
SQL = {"op8_line_dedup": line_dedup.SQL, "op10_mix_sources": mixing.SQL, "op11_centroid_clusters": clustering.SQL, "op12_collocations": collocations.SQL}
