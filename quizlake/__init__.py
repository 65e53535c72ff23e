"""quizlake: passages to multiple-choice questions as Spark DataFrame jobs."""
