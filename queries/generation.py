"""Generation queries. The synthesizer and diarizer are fixed rules that SQL can state too."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcurate.functions import names
from clipcurate.plans import generate as plans
from clipcurate.plans.hooks import diarize, diarize_in_units, generate, generate_in_units
from clipcurate.session import scratch_path
from queries import views


def make_stub_synthesizer():
    def speak(text, ref_path, exaggeration, cfg_weight, file):
        if len(text) % 7 == 0:
            raise ValueError("stub")
        return 40 * len(text), 1000

    return speak


def make_stub_diarizer():
    """Half a second in every kilobyte; two speakers above 6 kB, and no answer for odd sizes of 11."""

    def listen(data, rate):
        if len(data) % 11 == 0:
            raise ValueError("stub")
        return [(i, i + 0.5, "A" if i < 6 else "B") for i in range(len(data) // 1000)]

    return listen


def _plan(spark, d, settings=plans.PRESETS):
    return plans.generation_plan(
        views.texts(spark, d),
        views.references(spark, d),
        plans.presets(spark, settings),
        "conv_id",
        "turn",
    )


def gen_plan(spark, d):
    return _plan(spark, d, (plans.DEFAULT_PRESET,)).select("ref_name", "sample_no", "text", "file")


def gen_presets(spark, d):
    return _plan(spark, d).select(
        "ref_name", "preset", "exaggeration", "cfg_weight", "sample_no", "file"
    )


def gen_log(spark, d):
    return generate(_plan(spark, d, (plans.DEFAULT_PRESET,)), make_stub_synthesizer)


def gen_summary(spark, d):
    return plans.generation_summary(gen_log(spark, d))


def references_sorted(spark, d):
    return views.references(spark, d).orderBy("ref_name")


def sample_names(spark, d):
    numbered = views.texts(spark, d).select(
        "conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("n")
    )
    return numbered.select(
        "conv_id", "turn", names.sample_file(F.lit("voice"), F.col("n")).alias("file")
    )


def diarize_hook(spark, d):
    return diarize(views.recordings(spark, d), make_stub_diarizer).drop("language")


def diarize_units(spark, d):
    """The same in units of a hundred conversations: a call that ends after some waves, and one that goes on."""
    recordings = views.recordings(spark, d)
    conversation = F.split("id", "-")[0].cast("long")
    wanted = recordings.select("language", "id", F.call_function("div", conversation, F.lit(100).cast("long")).cast("string").alias("unit"))
    folder = scratch_path(spark, "progress")
    diarize_in_units(recordings, wanted, make_stub_diarizer, folder, wave_units=2, most_waves=1)
    return diarize_in_units(recordings, wanted, make_stub_diarizer, folder).drop("language")


def gen_units(spark, d):
    """The log of a call that ends after some waves, and of one that goes on."""
    plan = _plan(spark, d, (plans.DEFAULT_PRESET,))
    folder = scratch_path(spark, "progress")
    generate_in_units(plan, make_stub_synthesizer, folder, wave_units=2, most_waves=1)
    return generate_in_units(plan, make_stub_synthesizer, folder)


QUERIES = {
    "q_gen_plan": gen_plan,
    "q_gen_presets": gen_presets,
    "q_gen_log": gen_log,
    "q_gen_summary": gen_summary,
    "q_references_sorted": references_sorted,
    "q_sample_names": sample_names,
    "q_diarize_hook": diarize_hook,
    "q_diarize_units": diarize_units,
    "q_gen_units": gen_units,
}

_LOG = """(select ref_name, preset, sample_no, text,
                  case when len(text) % 7 = 0 then null else file end as file,
                  case when len(text) % 7 = 0 then 0.0 else cast(4 * len(text) as double) / 100 end as duration,
                  case when len(text) % 7 = 0 then 'error: stub' else 'ok' end as status
           from plan where preset = 'balanced')"""

ORACLE = {
    "q_gen_plan": views.sql(
        "select ref_name, sample_no, text, file from plan where preset = 'balanced'", "plan"
    ),
    "q_gen_presets": views.sql(
        """select ref_name, preset, exaggeration, cfg_weight, sample_no, case when preset = 'balanced' then file else concat(preset, '/', file) end as file
           from plan""",
        "plan",
    ),
    "q_gen_log": views.sql(f"select * from {_LOG}", "plan"),
    "q_gen_summary": views.sql(
        f"""select ref_name, count(*) filter (status = 'ok') as succeeded, count(*) as attempted,
                   cast(sum(cast(round(duration * 100) as bigint)) as double) / 100 as total_seconds
            from {_LOG} group by 1""",
        "plan",
    ),
    "q_references_sorted": views.sql("select ref_name, ref_path from refs order by 1", "refs"),
    "q_sample_names": """select conv_id, turn, concat('voice_sample_', case when n < 1000
            then lpad(cast(n as varchar), 3, '0') else cast(n as varchar) end, '.wav') as file
        from (select conv_id, turn, conv_id * 100 + turn as n from conversations)""",
    "q_diarize_hook": views.sql(
        """select id as clip_id, cast(null as bigint) as start_us, cast(null as bigint) as end_us,
                  cast(null as varchar) as speaker,
                  case when size % 11 = 0 then 'error: stub' else 'ok' end as status
           from recordings where size % 11 = 0 or size < 1000
           union all
           select id, i * 1000000, i * 1000000 + 500000, case when i < 6 then 'A' else 'B' end, 'ok'
           from (select id, unnest(range(0, size // 1000)) as i from recordings where size % 11 <> 0)""",
        "recordings",
    ),
}
ORACLE["q_diarize_units"] = ORACLE["q_diarize_hook"]
ORACLE["q_gen_units"] = ORACLE["q_gen_log"]
