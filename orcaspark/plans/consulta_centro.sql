-- Planned amounts of one year and plan by cost centre, from a least amount on.
SELECT CODCCUSTO, count(*) AS linhas, CAST(sum(Valor_Ajustado) AS DECIMAL(28, 2)) AS Valor_Ajustado
FROM planejado_com_centro
WHERE ANO = :ano AND Descricao_PPA = :ppa
GROUP BY CODCCUSTO
HAVING sum(Valor_Ajustado) >= :minimo
