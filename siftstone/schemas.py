"""Explicit schemas of inputs and tables; nothing is inferred on read."""

CANDIDATES = "poi STRING, ord INT, candidate_id STRING, path STRING, width INT, height INT, phash BIGINT, embedding ARRAY<FLOAT>, score DOUBLE"
URL_ENTRY = "url STRING, source STRING, category STRING, subpage STRING"
URL_ENTRIES = f"poi STRING, ord INT, {URL_ENTRY}"
MANIFEST = "poi_name STRING, extracted_at TIMESTAMP, source_counts MAP<STRING,BIGINT>, total BIGINT, urls ARRAY<STRUCT<url:STRING,source:STRING,category:STRING,subpage:STRING>>"
DETECTIONS = "candidate_id STRING, img_w INT, img_h INT, dets ARRAY<STRUCT<bbox:ARRAY<ARRAY<DOUBLE>>,text:STRING,conf:DOUBLE>>"
REPLIES = "poi STRING, content STRING, expected_count INT"
SNAPSHOTS = "poi STRING, snapshot STRING"
TABLES = {
    "optimization_layer": "id STRING, poi_name STRING, scraped_pics STRING, scraped_count INT, img_count INT, clip_count INT, processing_status STRING, updated_at TIMESTAMP",
    "poi_batches": "id STRING, poi_name STRING, clips_folder STRING, simple_overlay_text STRING, optimization_layer_id STRING, compilation_status STRING",
    "compiled_videos": "id STRING, poi_id STRING, video_variation STRING, publishing_status STRING, compressed_video_url STRING",
    "text_overlay_variations": "compiled_video_id STRING, overlay_text STRING, final_output_url STRING, status STRING",
    "pois_cache": "poi_name STRING, location STRING, notes STRING, first_synced_at TIMESTAMP",
    "music_library": "id STRING, music_name STRING, created_at TIMESTAMP",
    "pipeline_runs": "run_id STRING, poi_names ARRAY<STRING>, poi_count INT, from_stage STRING, triggered_by STRING, config STRING, parent_run_id STRING, status STRING, started_at TIMESTAMP, completed_at TIMESTAMP, summary STRING, error_message STRING",
    "pipeline_run_steps": "run_id STRING, poi_name STRING, stage STRING, status STRING, started_at TIMESTAMP, completed_at TIMESTAMP, duration_s DOUBLE, metrics STRING, error_message STRING",
}
