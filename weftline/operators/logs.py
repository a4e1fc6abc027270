"""Training logs, task labels and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Names of models in the labels of training tasks, and of evaluation tasks.
TRAINED = (
    "backtranslations-train-backwards-model", "backward", "backwards", "distillation-student-model-finetune", "distillation-student-model-train",
    "finetune-student", "finetune-teacher", "finetuned-student", "quantized", "student", "student-finetuned",
    "teacher", "teacher-all", "teacher-base", "teacher-ensemble", "teacher-finetuned", "teacher-model", "teacher-parallel",
)
EVALUATED = (
    "backward", "backwards", "finetune-student", "finetune-teacher", "finetuned-student", "quantized", "student", "student-finetuned",
    "teacher", "teacher-all", "teacher-base", "teacher-ensemble", "teacher-finetuned", "teacher-parallel",
)
#: Importers of evaluation sets, and what names of models became later.
IMPORTERS = ("flores", "mtdata", "sacrebleu", "url")
RENAMED = {"backtranslations-train-backwards-model": "backwards", "backward": "backwards", "distillation-student-model-finetune": "finetune-student", "distillation-student-model-train": "student", "teacher-model": "teacher"}


def _fields(text: Column) -> Column:
    """What a trainer reports, from the epoch on: fields with a colon between them."""
    return F.transform(F.split(F.substr(text, F.instr(text, "Ep. ")), ":"), lambda x: F.trim(x))


def _number(text: Column) -> Column:
    """An unsigned decimal, without the commas that group its digits; null if it is anything else."""
    plain = F.replace(text, F.lit(","), F.lit(""))
    return F.when(F.translate(plain, "0123456789.", "") == "", plain.try_cast("double"))


def _of(fields: Column, name: str) -> Column:
    """The word behind a field's name, or before it where the name is a unit (begins with a space)."""
    if name.startswith(" "):
        found = F.get(F.filter(fields, lambda x: F.endswith(x, F.lit(name))), F.lit(0))
        return F.split_part(found, F.lit(" "), F.lit(1))
    found = F.get(F.filter(fields, lambda x: F.startswith(x, F.lit(f"{name} "))), F.lit(0))
    return F.split_part(F.substr(found, F.lit(len(name) + 2)), F.lit(" "), F.lit(1))


def training_epochs(lines: DataFrame, column: str = "text") -> DataFrame:
    """lines that report training, with epoch, up, sen, cost, time, rate, gnorm and learning_rate.

    Such a line gives 'Ep. n', 'Up. n', 'Sen. n', 'Cost x', 'Time xs', 'x words/s', 'gNorm x' and perhaps 'L.r. x'.
    """
    d = lines.where(F.col(column).contains("Ep. ")).withColumn("_f", _fields(F.col(column)))
    f = F.col("_f")
    d = d.withColumns({
        "epoch": _number(_of(f, "Ep.")).cast("long"), "up": _number(_of(f, "Up.")).cast("long"), "sen": _number(_of(f, "Sen.")).cast("long"), "cost": _number(_of(f, "Cost")),
        "time": _number(F.rtrim(_of(f, "Time"), F.lit("s"))), "rate": _number(_of(f, " words/s")), "gnorm": _number(_of(f, "gNorm")), "learning_rate": _of(f, "L.r.").try_cast("double"),
    })
    return d.where(" AND ".join(f"{c} IS NOT NULL" for c in ("epoch", "up", "sen", "cost", "time", "rate", "gnorm"))).drop("_f")


def validation_values(lines: DataFrame, column: str = "text") -> DataFrame:
    """lines that report validation, with epoch, up, key (underscores), value and stalled.

    Such a line is marked [valid] and gives 'Ep. n', 'Up. n', a metric's name, its value, and how it compares.
    """
    d = lines.where(F.col(column).contains("[valid]") & F.col(column).contains("Ep. ")).withColumn("_f", _fields(F.col(column)))
    f = F.col("_f")
    last = F.get(f, F.lit(4))
    d = d.withColumns({
        "epoch": _number(_of(f, "Ep.")).cast("long"), "up": _number(_of(f, "Up.")).cast("long"), "key": F.replace(F.get(f, F.lit(2)), F.lit("-"), F.lit("_")), "value": _number(F.get(f, F.lit(3))),
        "stalled": F.when(F.startswith(last, F.lit("stalled ")), _number(F.split_part(last, F.lit(" "), F.lit(2)))).cast("long"),
    })
    return d.where("epoch IS NOT NULL AND up IS NOT NULL AND key <> '' AND value IS NOT NULL").drop("_f")


REQUIRED = ("chrf", "ce_mean_words", "bleu_detok")


def assembled(values: DataFrame) -> DataFrame:
    """(epoch, up, chrf, ce_mean_words, bleu_detok, perplexity): records whose required values have all arrived."""
    pick = [F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in (*REQUIRED, "perplexity")]
    return values.groupBy("epoch", "up").agg(*pick).where(" AND ".join(f"{k} IS NOT NULL" for k in REQUIRED))


def deltas(df: DataFrame, run: str, order: str, value: str) -> DataFrame:
    return df.withColumn("delta", F.col(value) - F.lag(value).over(Window.partitionBy(run).orderBy(order)))


def from_marker(lines: DataFrame, run: str, order: str, marker: str = "[marian]") -> DataFrame:
    """Each run's lines from the first with the marker on, without task prefixes."""
    seen = F.max(F.col("text").contains(marker).cast("int")).over(Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("_seen", seen).where("_seen = 1").drop("_seen").withColumn("text", F.regexp_replace("text", r"^\[task [^\]]*Z\] ", ""))


def metrics_after(lines: DataFrame, run: str, order: str, marker: str) -> DataFrame:
    """(run, bleu_detok, chrf): the two numbers on the lines after each run's first marker that has them."""
    w = Window.partitionBy(run).orderBy(order)
    a, b = (F.lead("text", i).over(w).try_cast("double") for i in (1, 2))
    x = lines.withColumn("bleu_detok", a).withColumn("chrf", b).where(F.col("text").rlike(marker) & F.col("bleu_detok").isNotNull() & F.col("chrf").isNotNull())
    return x.groupBy(run).agg(F.min_by("bleu_detok", order).alias("bleu_detok"), F.min_by("chrf", order).alias("chrf"))


def _leading(text: Column, names: tuple[str, ...]) -> Column:
    """The longest of names that text begins with, where the text ends or a sign or digit follows; null if there is none."""
    follows = lambda n: F.substr(text, F.length(n) + 1, F.lit(1))
    fit = F.filter(F.array(*(F.lit(n) for n in sorted(names, key=len, reverse=True))), lambda n: F.startswith(text, n) & F.rlike(follows(n), F.lit("^[-_0-9]?$")))
    return F.get(fit, F.lit(0))


def _after(text: str, head: str) -> Column:
    return F.substr(F.col(text), F.length(head) + 1)


def _some(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def parsed_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """df with model, importer, dataset and augmentation of a task's label; all null if it is none.

    A training label is a model's name, perhaps behind 'train-', then perhaps the number of a copy, a language pair and
    again a number, '2_3' being the second of three. An evaluation label is 'evaluate' or 'eval', a model's name, perhaps a
    number, an importer (perhaps twice), perhaps 'aug-...', a data set, and perhaps a language pair and a number. Each step
    reads a field and leaves the rest; steps are projected one after another, so none is worked out twice.
    """
    c = F.col
    # Training: the name, and what may follow it.
    d = df.withColumn("_t", F.regexp_replace(label, "^train-", "")).withColumn("_name", _leading(c("_t"), TRAINED)).withColumn("_rest", _after("_t", "_name"))
    d = d.withColumn("_copy", _some(c("_rest"), "^-?([0-9]+)"))
    d = d.withColumn("_tail", F.regexp_replace(F.regexp_replace("_rest", "^-?[0-9]+", ""), "^[-_]?[a-z]{2,3}-[a-z]{2,3}(?![a-z])", ""))
    d = d.withColumn("_trains", F.coalesce(c("_name").isNotNull() & c("_tail").rlike("^(-*[0-9]+([/_][0-9]+)?)?$"), F.lit(False)))
    d = d.withColumn("_number", F.coalesce("_copy", _some(c("_tail"), "^-*([0-9]+)")))
    # Evaluation: fields from the left, then from the right.
    d = d.withColumn("_e", F.regexp_extract(label, "^eval(?:uate)?[-_](.*)$", 1)).withColumn("_model", _leading(c("_e"), EVALUATED)).withColumn("_rest", _after("_e", "_model"))
    d = d.withColumn("_nth", _some(c("_rest"), "^-?([0-9]+)[-_]")).withColumn("_rest", F.regexp_replace("_rest", "^(-?[0-9]+)?[-_]", ""))
    d = d.withColumn("_importer", _leading(c("_rest"), IMPORTERS)).withColumn("_rest", _after("_rest", "_importer"))
    d = d.withColumn("_rest", F.when(c("_rest").rlike(f"^-({'|'.join(IMPORTERS)})[-_]") & F.startswith("_rest", F.concat(F.lit("-"), "_importer")), F.substr("_rest", F.length("_importer") + 2)).otherwise(c("_rest")))
    d = d.withColumn("_rest", F.substr("_rest", F.lit(2))).withColumn("_aug", _some(c("_rest"), "^(aug-[^_]*)_")).withColumn("_rest", F.regexp_replace("_rest", "^aug-[^_]*_", ""))
    d = d.withColumn("_last", _some(c("_rest"), "-([0-9]+)(?:[/_][0-9]+)?$"))
    d = d.withColumn("_set", F.regexp_replace(F.regexp_replace("_rest", "-[0-9]+([/_][0-9]+)?$", ""), "-[a-z]{2,3}-[a-z]{2,3}$", ""))
    d = d.withColumn("_tests", F.coalesce(~c("_trains") & c("_model").isNotNull() & c("_importer").isNotNull(), F.lit(False)))
    # Both: later names, the number, and a first teacher.
    later = F.create_map(*(F.lit(x) for kv in RENAMED.items() for x in kv))
    d = d.withColumn("_called", F.replace(F.when(c("_trains"), c("_name")).when(c("_tests"), c("_model")), F.lit("finetuned"), F.lit("finetune")))
    d = d.withColumn("_called", F.coalesce(F.element_at(later, F.coalesce("_called", F.lit(""))), "_called"))
    number = F.coalesce(F.when(c("_trains"), c("_number")).when(c("_tests"), F.coalesce("_nth", "_last")), F.when(c("_called") == "teacher", F.lit("1")))
    d = d.withColumn("_suffix", number)
    of = lambda x: F.when(c("_tests"), c(x))
    d = d.withColumns({"model": F.when(c("_suffix").isNull(), c("_called")).otherwise(F.concat_ws("-", "_called", "_suffix")), "importer": of("_importer"), "dataset": of("_set"), "augmentation": of("_aug")})
    return d.drop("_t", "_name", "_rest", "_copy", "_tail", "_trains", "_number", "_e", "_model", "_nth", "_importer", "_aug", "_last", "_set", "_tests", "_called", "_suffix")


def latest_task(tasks: DataFrame, pattern: str, earliest: bool = False) -> DataFrame:
    """Of tasks whose last run is completed and whose label matches, the newest (or oldest) of each label; of equal ones the greatest (least) id."""
    done = tasks.where((F.element_at("states", -1) == "completed") & F.col("label").rlike(pattern))
    pick = (F.min if earliest else F.max)(F.struct("created", "task_id")).alias("x")
    return done.groupBy("label").agg(pick).select("label", "x.task_id", "x.created")


def completed_at(runs: Column) -> Column:
    """When the last completed run was resolved. runs: array of (state, resolved)."""
    return F.try_element_at(F.filter(runs, lambda r: r["state"] == "completed"), F.lit(-1))["resolved"]


def chunk_number(label: Column) -> Column:
    """The chunk that a task's label ends in, '...-7' or '...-7/20', as a number; null without one."""
    return F.nullif(F.regexp_extract(label, r"[-_]([0-9]+)(?:/[0-9]+)?$", 1), F.lit("")).cast("long")


def runs_with_metrics(training: DataFrame, evaluations: DataFrame) -> DataFrame:
    """(task_id, model, eval_id): evaluations that depend on a training task and are of its model; unmatched tasks stay."""
    e = evaluations.select("eval_id", F.col("model").alias("m"), F.explode("dependencies").alias("d"))
    return training.join(e, (F.col("task_id") == F.col("d")) & (F.col("model") == F.col("m")), "left").select("task_id", "model", "eval_id")


def missing_runs(metrics: DataFrame, training: DataFrame) -> DataFrame:
    return metrics.join(training.select("model").distinct(), "model", "left_anti").select("model").distinct()


def metrics_by_model(*sources: DataFrame) -> DataFrame:
    """(model, n, metrics): metrics of all sources as one ordered text for each model."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    row = F.concat_ws("/", "importer", "dataset", F.coalesce("augmentation", F.lit("-")), F.col("bleu_detok").cast("decimal(8,2)").cast("string"), F.col("chrf").cast("decimal(8,2)").cast("string"))
    return out.groupBy("model").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(row)), ";").alias("metrics"))


def resumable_run(runs: DataFrame, required: list[list[str]]) -> DataFrame:
    """The newest run that holds all artifacts of one of the required sets. runs: (run_id, artifacts)."""
    ok = F.lit(False)
    for names in required:
        ok = ok | (F.size(F.array_except(F.array(*(F.lit(n) for n in names)), F.col("artifacts"))) == 0)
    return runs.where(ok).agg(F.max("run_id").alias("run_id")).where("run_id IS NOT NULL")


def gap_corrected(times: DataFrame, run: str, order: str, at: str, most: float = 1200.0) -> DataFrame:
    """df with `wall`: seconds since each run's start, where a gap above `most` counts as the mean of the lesser gaps before
    it, or as nothing where there are none. All its windows share one sort of the run's rows."""
    w = Window.partitionBy(run).orderBy(order)
    gap = (F.col(at) - F.lag(at).over(w)).cast("double")
    d = times.withColumn("_gap", gap)
    mean = F.avg(F.when(F.col("_gap") <= most, F.col("_gap"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_gap", F.when(F.col("_gap") > most, F.coalesce(mean, F.lit(0.0))).otherwise(F.col("_gap")))
    return d.withColumn("wall", F.coalesce(F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))).drop("_gap")
